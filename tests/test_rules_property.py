"""Rules 3 and 4 against a brute-force Python evaluation on random inputs
(ties in time, NULL amounts and cities, unknown terminals, several days)."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from helpers import FACT_DDL
from ledgerhawk.config import FIXTURE_DOMAINS
from ledgerhawk.operators import amount_probes, city_hops

CITY = {"T1": "Moscow", "T2": "Kazan", "T3": "Moscow", "T4": None}


def random_fact(seed, n=300):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        card = rnd.choice(["HOT"] * 4 + [f"c{k}" for k in range(8)])
        t = base + timedelta(days=rnd.randint(0, 2), hours=rnd.randint(8, 11), minutes=rnd.choice([0, 0, 7, 30, 59]))
        amt = None if rnd.random() < 0.05 else Decimal(rnd.randint(1, 9) * 10)
        res = rnd.choice(["success", "refused", "refused", "other"])
        term = rnd.choice(["T1", "T2", "T3", "T4", "T9"])
        rows.append((f"{i:04d}", t, card, "payment", amt, res, term))
    return rows


def brute_hops(rows):
    seqs = defaultdict(list)
    for r in rows:
        if r[6] in CITY:  # inner join with terminals
            seqs[(r[2], r[1].date())].append(r)
    out = []
    for seq in seqs.values():
        seq.sort(key=lambda r: (r[1], r[0]))
        for p, c in zip(seq, seq[1:]):
            pc, cc = CITY[p[6]], CITY[c[6]]
            if c[1] - p[1] <= timedelta(hours=1) and pc is not None and cc is not None and pc != cc:
                out.append((c[2], c[1]))
    return sorted(out)


def brute_probes(rows):
    seqs = defaultdict(list)
    for r in rows:
        seqs[(r[2], r[1].date())].append(r)
    out = []
    for seq in seqs.values():
        if len(seq) <= 3:
            continue
        seq.sort(key=lambda r: (r[1], r[0]))
        codes = [1 if r[5] == "success" else 0 if r[5] == "refused" else None for r in seq]
        total = sum(c for c in codes if c is not None) if any(c is not None for c in codes) else None
        rising = 0
        for p, c in zip(seq, seq[1:]):
            if p[4] is None:
                continue
            if c[4] is not None and c[4] < p[4]:
                continue
            rising += 1
        if total == 1 and seq[-1][5] == "success" and rising == 0:
            out.append((seq[-1][2], seq[-1][1]))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_city_hops_match_brute_force(spark, seed):
    rows = random_fact(seed)
    fact = spark.createDataFrame(rows, FACT_DDL)
    terms = spark.createDataFrame([(k, "POS", v, "a") for k, v in CITY.items()],
                                  "terminal_id string, terminal_type string, terminal_city string, "
                                  "terminal_address string")
    got = sorted((r.card_num, r.trans_date) for r in city_hops(fact, terms, hot_rows=4).collect())
    assert got == brute_hops(rows)


@pytest.mark.parametrize("seed", [4, 5])
def test_amount_probes_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = random_fact(seed, 120)
    # plant falling sequences ending in one success
    for k in range(6):
        day = datetime(2024, 1, 1 + k % 3, 12)
        n = rnd.randint(4, 6)
        for j in range(n):
            res = "success" if j == n - 1 else "refused"
            rows.append((f"p{k}{j}", day + timedelta(minutes=3 * j), f"probe{k}", "payment",
                         Decimal(100 - 10 * j), res, "T1"))
    fact = spark.createDataFrame(rows, FACT_DDL)
    got = sorted((r.card_num, r.trans_date) for r in amount_probes(fact, FIXTURE_DOMAINS, hot_rows=4).collect())
    exp = brute_probes(rows)
    assert got == exp and len(exp) >= 6

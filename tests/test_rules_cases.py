"""Hand-made cases for the four rules (one per easy-to-get-wrong detail)."""

import pytest
from pyspark.sql import functions as F

from helpers import fact, owner_dims, terminals, ts
from ledgerhawk.config import FIXTURE_DOMAINS, ts_literal
from ledgerhawk.operators import amount_probes, city_hops, rule_expired_account, rule_expired_passport
from ledgerhawk.operators.rules import fraud_report

def RT():
    return ts_literal("2024-01-02 00:00:00")


def hops(spark, rows, hot_rows=1_000_000):
    t = terminals(spark, [("T1", "Moscow"), ("T2", "Kazan"), ("T3", "Moscow")])
    out = city_hops(fact(spark, rows), t, hot_rows=hot_rows)
    return sorted((r.card_num, str(r.trans_date)) for r in out.collect())


@pytest.mark.parametrize("chunk", [1, 60, 3600, 86400])
def test_gap_exactly_one_hour_is_flagged(spark, chunk):
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1"),
            ("2", "2024-01-01 11:00:00", "C", 1, "success", "T2")]
    assert hops(spark, rows, chunk) == [("C", "2024-01-01 11:00:00")]


def test_gap_one_hour_and_a_microsecond_is_not(spark):
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1"),
            ("2", "2024-01-01 11:00:00.000001", "C", 1, "success", "T2")]
    assert hops(spark, rows) == []


def test_same_city_is_not_flagged(spark):
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1"),
            ("2", "2024-01-01 10:10:00", "C", 1, "success", "T3")]
    assert hops(spark, rows) == []


def test_pair_across_midnight_is_not_compared(spark):
    rows = [("1", "2024-01-01 23:50:00", "C", 1, "success", "T1"),
            ("2", "2024-01-02 00:10:00", "C", 1, "success", "T2")]
    assert hops(spark, rows) == []


def test_unknown_terminal_leaves_the_sequence(spark):
    # The middle operation is at an unknown terminal: the third is compared
    # with the first (the terminal join comes before LAG).
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1"),
            ("2", "2024-01-01 10:20:00", "C", 1, "success", "T9"),
            ("3", "2024-01-01 10:40:00", "C", 1, "success", "T2")]
    assert hops(spark, rows) == [("C", "2024-01-01 10:40:00")]


def test_only_consecutive_operations_count(spark):
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1"),
            ("2", "2024-01-01 10:30:00", "C", 1, "success", "T3"),
            ("3", "2024-01-01 10:31:00", "C", 1, "success", "T1")]
    assert hops(spark, rows) == []


@pytest.mark.parametrize("chunk", [1, 60, 86400])
def test_hot_card_split_over_chunks_matches_lag(spark, chunk):
    rows = []
    for i in range(200):
        term = "T1" if (i // 3) % 2 == 0 else "T2"
        rows.append((f"{i:04d}", f"2024-01-01 10:{i // 60 % 60:02d}:{i % 60:02d}", "HOT", 1, "success", term))
    got = hops(spark, rows, chunk)
    expected = sorted(("HOT", str(ts(r[1]))) for i, r in enumerate(rows)
                      if i > 0 and ((i // 3) % 2) != (((i - 1) // 3) % 2))
    assert got == expected


def probes(spark, rows):
    out = amount_probes(fact(spark, rows), FIXTURE_DOMAINS)
    return sorted((r.card_num, str(r.trans_date)) for r in out.collect())


def seq(amts, results, card="C"):
    return [(f"{i}", f"2024-01-01 10:0{i}:00", card, a, r, "T1") for i, (a, r) in enumerate(zip(amts, results))]


def test_amount_probe_four_falling_last_success(spark):
    rows = seq([500, 400, 300, 200], ["refused"] * 3 + ["success"])
    assert probes(spark, rows) == [("C", "2024-01-01 10:03:00")]


def test_amount_probe_needs_more_than_three(spark):
    assert probes(spark, seq([400, 300, 200], ["refused"] * 2 + ["success"])) == []


def test_amount_probe_equal_amounts_break_it(spark):
    assert probes(spark, seq([500, 400, 400, 200], ["refused"] * 3 + ["success"])) == []


def test_amount_probe_two_successes(spark):
    assert probes(spark, seq([500, 400, 300, 200], ["success", "refused", "refused", "success"])) == []


def test_amount_probe_success_not_last(spark):
    assert probes(spark, seq([500, 400, 300, 200], ["refused", "refused", "success", "refused"])) == []


def test_amount_probe_null_amount_is_not_falling(spark):
    assert probes(spark, seq([500, None, 300, 200], ["refused"] * 3 + ["success"])) == []


def test_amount_probe_across_chunks(spark):
    rows = [(f"{i}", f"2024-01-01 {10 + i:02d}:00:00", "C", 1000 - i, "refused", "T1") for i in range(9)]
    rows.append(("9", "2024-01-01 21:00:00", "C", 1, "success", "T1"))
    assert probes(spark, rows) == [("C", "2024-01-01 21:00:00")]
    rows[4] = ("4", "2024-01-01 14:00:00", "C", 5000, "refused", "T1")
    assert probes(spark, rows) == []


def test_expiry_same_instant_not_flagged_one_microsecond_later_flagged(spark):
    dims = owner_dims(spark, ["C"], passport_valid_to="2024-01-01 10:00:00",
                      account_valid_to="2024-01-01 10:00:00")
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1"),
            ("2", "2024-01-01 10:00:00.000001", "C", 1, "success", "T1")]
    f = fact(spark, rows)
    p = [str(r.fraud_dt) for r in rule_expired_passport(f, dims, RT()).collect()]
    a = [str(r.fraud_dt) for r in rule_expired_account(f, dims, RT()).collect()]
    assert p == ["2024-01-01 10:00:00.000001"] and a == p


def test_unknown_card_drops_out_of_report(spark):
    dims = owner_dims(spark, ["C"], passport_valid_to="2000-01-01 00:00:00")
    dims["terminals"] = terminals(spark, [("T1", "Moscow")])
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1"),
            ("2", "2024-01-01 10:00:00", "X", 1, "success", "T1")]
    rep = fraud_report(fact(spark, rows), dims, RT(), FIXTURE_DOMAINS)
    assert [(r.passport, r.fio) for r in rep.collect()] == [("PC", "Last First Middle")]


def test_fio_is_null_when_a_name_part_is_null(spark):
    dims = owner_dims(spark, ["C"], passport_valid_to="2000-01-01 00:00:00")
    dims["clients"] = dims["clients"].withColumn("patronymic", F.lit(None).cast("string"))
    rows = [("1", "2024-01-01 10:00:00", "C", 1, "success", "T1")]
    got = rule_expired_passport(fact(spark, rows), dims, RT()).collect()
    assert len(got) == 1 and got[0].fio is None

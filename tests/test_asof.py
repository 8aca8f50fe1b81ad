"""The as-of join of versions equals the residual join, also for keys with very many versions."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ledgerhawk.operators.rules import _join_dim, versions_in_force
from ledgerhawk.operators.scd import with_day_validity

START = datetime(2024, 1, 1)


def history(spark, rows):
    """rows: (key, value, start, end)."""
    return with_day_validity(spark.createDataFrame(rows, "k string, v string, start_dt timestamp_ntz, end_dt timestamp_ntz"))


def test_equals_the_residual_join(spark):
    rng, rows = random.Random(1), []
    for k in range(12):
        at = START + timedelta(hours=rng.randrange(200))
        for n in range(rng.randrange(1, 12)):
            end = at + timedelta(hours=rng.choice([1, 2, 5, 30, 100]))
            last = rng.random() < 0.2
            rows.append((f"k{k}", f"v{n}", at, None if last else end))
            if last:
                break
            at = end + timedelta(hours=rng.choice([0, 0, 0, 50]))  # sometimes a gap
    hist = history(spark, rows)
    facts = spark.createDataFrame([(f"k{rng.randrange(14)}", date(2024, 1, 1) + timedelta(days=rng.randrange(40)), i)
                                   for i in range(400)] + [(None, date(2024, 1, 1), 1000)], "key string, day date, i int")
    got = _join_dim(facts, hist, "key", "k", ["v"])
    valid = (F.col("valid_from_day") <= F.col("day")) & (F.col("valid_to_day").isNull() | (F.col("valid_to_day") > F.col("day")))
    exp = facts.join(hist, (F.col("key") == F.col("k")) & valid).select("key", "day", "i", "v")
    assert got.columns == ["key", "day", "i", "v"] and got.count() > 50
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_a_key_with_ten_thousand_versions(spark):
    rows = [("hot", f"v{n}", START + timedelta(hours=n), START + timedelta(hours=n + 1)) for n in range(10_000)]
    pairs = spark.createDataFrame([("hot", date(2024, 1, 1) + timedelta(days=d)) for d in range(400)], "_k string, day date")
    got = {r.day: r._d_v for r in versions_in_force(pairs, history(spark, rows), "k", ["v"]).collect()}
    assert len(got) == 400
    for d, v in got.items():
        assert v == f"v{(d - date(2024, 1, 1)).days * 24 + 23}"


def test_no_join_multiplies_rows_by_versions(spark):
    """Every join with a history is on (key, day); none has a residual condition."""
    hist = history(spark, [("a", "x", START, None)])
    facts = spark.createDataFrame([("a", date(2024, 1, 2))], "key string, day date")
    plan = _join_dim(facts, hist, "key", "k", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "<=" not in joins[0] and joins[0].count("=") == 2

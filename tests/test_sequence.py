"""exact_lag equals a plain LAG window whichever groups are split, and how."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerhawk.operators.sequence import cut_points, exact_lag, hot_buckets


def operations(spark, seed, one_minute):
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        card = "HOT" if rnd.random() < 0.4 else f"c{rnd.randint(0, 20)}"
        day = "2024-01-01" if card == "HOT" else f"2024-01-0{rnd.randint(1, 3)}"
        t = f"{day} 10:00:00" if one_minute else \
            f"{day} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}"
        rows.append((f"{i:05d}", t, card, rnd.choice(["a", "b", None]), rnd.randint(0, 9)))
    return (spark.createDataFrame(rows, "id string, t string, card string, city string, v int")
            .withColumn("ts", F.col("t").cast("timestamp_ntz")).withColumn("day", F.to_date("ts")))


@pytest.mark.parametrize("hot_rows", [1, 8, 50, 1000])
@pytest.mark.parametrize("one_minute", [False, True])
def test_exact_lag_equals_window_lag(spark, hot_rows, one_minute):
    df = operations(spark, hot_rows, one_minute)
    got = exact_lag(df, ["card", "day"], ["ts", "id"], ["ts", "city", "v"], hot_rows=hot_rows)
    w = Window.partitionBy("card", "day").orderBy("ts", "id")
    exp = df.select("id", F.lag("ts").over(w).alias("prev_ts"), F.lag("city").over(w).alias("prev_city"),
                    F.lag("v").over(w).alias("prev_v"))
    g = got.select("id", "prev_ts", "prev_city", "prev_v")
    assert g.exceptAll(exp).count() == 0 and exp.exceptAll(g).count() == 0
    assert g.count() == 600


def test_only_hot_buckets_are_cut(spark):
    df = operations(spark, 3, False)
    assert len(hot_buckets(df, ["card", "day"], 100).first().hot) == 1  # the card HOT
    assert hot_buckets(df, ["card", "day"], 600).first().hot == []
    cuts = cut_points(df, ["card", "day"], "ts", 100).first().cuts
    assert len(cuts) == 1
    points = next(iter(cuts.values()))
    assert points == sorted(points) and len(set(points)) > 50
    assert cut_points(df, ["card", "day"], "ts", 600).first().cuts == {}


def test_building_a_query_starts_no_job(spark):
    df = operations(spark, 4, False)
    sc = spark.sparkContext
    sc.setJobGroup("building", "no job may run")
    try:
        lagged = exact_lag(df, ["card", "day"], ["ts", "id"], ["v"], hot_rows=50)
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
        assert lagged.count() == 600
        assert list(sc.statusTracker().getJobIdsForGroup("building")) != []
    finally:
        sc.setJobGroup("", "")


def test_rows_are_exchanged_once(spark, tmp_path):
    """However large: the rows have one exchange, on group and range; the boundary table joins on the same."""
    operations(spark, 5, False).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lagged = exact_lag(spark.read.parquet(str(tmp_path / "t")), ["card", "day"], ["ts", "id"], ["v"], hot_rows=50)
        plan = lagged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    main = plan[:plan.index("Subquery")] if "Subquery" in plan else plan
    left = main[main.index("Join"):]
    window = left.index("Window [lag(")
    assert "hashpartitioning(card" not in left[:window] and "Exchange" not in left[:window]

"""Skew-safe ``LAG`` over long ordered sequences, in one exchange of the rows.

``LAG(x) OVER (PARTITION BY card, day ORDER BY ts)`` is one exchange and one
sort. A group with very many rows would be one long task, so its rows are cut into ranges
of the order: rows are exchanged and sorted by (group, range), the previous row is taken
inside each range, and a range's first row gets the last row of the ranges
before it from a small boundary table, joined on what the rows are already partitioned by.

Which groups are cut is decided while the query runs, inside its plan: rows are counted per
hash bucket of their group (65,536 counts, combined map-side), and buckets far above both
``hot_rows`` and the mean get cut points from approximate percentiles of their times. Both
are scalar subqueries, so no job runs before the action, no list of keys reaches the driver
program, and without such buckets every range is 0 and the boundary table empty. The
result is exactly ``LAG`` however the rows are cut, also if all rows share one time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a single task may sort for one group.
HOT_ROWS = 1_000_000
#: Ranges of a bucket, hash buckets, and how far above the mean bucket a hot one is.
RANGES, _BUCKETS, _FACTOR = 64, 1 << 16, 16


def _bucket(by: list[str]) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(_BUCKETS)).cast("int")


def hot_buckets(df: DataFrame, by: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row: the buckets (at most ``_BUCKETS / _FACTOR``) of groups that are too long for a task."""
    sizes = df.groupBy(_bucket(by).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    full = sizes.agg(F.collect_list(F.when(F.col("n") > hot_rows, F.struct("b", "n"))).alias("full"), F.sum("n").alias("total"))
    return full.select(F.transform(F.filter("full", lambda x: x["n"] * _BUCKETS > F.col("total") * _FACTOR),
                                   lambda x: x["b"]).alias("hot"))


def cut_points(df: DataFrame, by: list[str], first: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row: a map from each hot bucket to ascending cut points of column ``first``."""
    hot = df.where(F.array_contains(hot_buckets(df, by, hot_rows).scalar(), _bucket(by)))
    shares = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    cuts = hot.groupBy(_bucket(by).alias("b")).agg(F.percentile_approx(first, shares, F.lit(1000)).alias("cuts"))
    return cuts.agg(F.map_from_entries(F.collect_list(F.struct("b", "cuts"))).alias("cuts"))


def exact_lag(df: DataFrame, by: list[str], order: list[str], values: list[str], prefix: str = "prev_",
              hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Add ``prev_<v>``: the value of ``v`` on the previous row of the same
    ``by`` group in ``order`` (``LAG``); ``order`` must not leave ties that matter.

    ``sizes``: rows with the columns ``by`` and ``order[0]`` to judge group sizes by, if that
    is cheaper than ``df`` (say, before a join); it only decides how the work is split."""
    cuts = F.element_at(cut_points(df if sizes is None else sizes, by, order[0], hot_rows).scalar(), _bucket(by))
    rows = df.withColumn("_cuts", cuts).withColumn(
        "_range", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col(order[0]))), F.lit(0)))
    rows = rows.withColumn("_hot", F.col("_cuts").isNotNull()).drop("_cuts").withColumn(
        "_range", F.when(F.col("_hot"), F.col("_range")).otherwise(0))
    place = F.struct(*[F.col(c) for c in order])
    held = F.struct(*[F.col(v) for v in values])
    # the boundary table: each range's last row, moved on to the next range of its group
    last = rows.where("_hot").groupBy(*by, "_range").agg(F.max_by(held, place).alias("_last"))
    carry = last.select(*by, "_range", F.lag("_last").over(Window.partitionBy(*by).orderBy("_range")).alias("_carry"))
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    found = rows.withColumn("_prev", F.lag(held).over(inside))
    joined = found.join(carry.where("_carry is not null"), [*by, "_range"], "left")
    prev = F.coalesce("_prev", "_carry")
    return joined.select(*df.columns, *[prev[v].alias(prefix + v) for v in values])

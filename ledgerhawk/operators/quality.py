"""Data-quality jobs standing in for the reference's table constraints
(primary keys, foreign keys, NOT NULL, list-partition domains, widths) and
for the SCD2 history invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row (primary-key check)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row."""
    keys = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def _unpivot_counts(counts: DataFrame, names: list[str], value: str) -> DataFrame:
    return counts.unpivot([], names, "column_name", value)


def null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: how many rows hold NULL there (one scan)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot_counts(counts, cols, "n_null")


def domain_violations(df: DataFrame, col: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose value is outside a list domain (a list partition without
    a default partition rejects NULL too)."""
    c = F.col(col)
    return df.where(c.isNull() | ~c.isin(*allowed))


def width_violations(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Per string column: rows longer than the declared ``VARCHAR(n)``."""
    cols = [c for c in widths if c in df.columns]
    counts = df.agg(*[F.count_if(F.length(c) > widths[c]).alias(c) for c in cols])
    return _unpivot_counts(counts, cols, "n_too_long")


def numeric_violations(df: DataFrame, col: str, precision: int = 10, scale: int = 2) -> DataFrame:
    """Rows whose value does not fit ``numeric(precision, scale)``."""
    c = F.col(col)
    return df.where(c.isNotNull() & c.try_cast(DecimalType(precision, scale)).isNull())


def history_check(hist: DataFrame, key: str) -> DataFrame:
    """Every version with a ``problem`` column (NULL when fine). SCD2
    invariants per key: at most one open version, the open version is the
    latest, and each closed version ends where the next one starts.
    Versions are few per key, so the window stays small."""
    w = Window.partitionBy(key).orderBy("start_dt")
    nxt = F.lead("start_dt").over(w)
    n_open = F.count_if(F.col("end_dt").isNull()).over(Window.partitionBy(key))
    h = hist.select("*", nxt.alias("_next"), n_open.alias("_n_open"))
    problem = (F.when(F.col("_n_open") > 1, F.lit("several_open"))
               .when(F.col("end_dt").isNull() & F.col("_next").isNotNull(), F.lit("open_not_last"))
               .when(F.col("end_dt").isNotNull() & F.col("_next").isNull(), F.lit("closed_last"))
               .when(F.col("end_dt") != F.col("_next"), F.lit("gap_or_overlap")))
    return h.withColumn("problem", problem).drop("_next", "_n_open")


def history_violations(hist: DataFrame, key: str) -> DataFrame:
    """Versions breaking an SCD2 invariant (see :func:`history_check`)."""
    return history_check(hist, key).where(F.col("problem").isNotNull())

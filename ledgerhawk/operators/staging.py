"""Staging: split landing into the four dimension feeds and the fact feed,
and reduce each feed to its distinct attribute variants."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import on_day
from ..schemas import DIMS, FACT_SOURCE, DimSpec

DAY = "load_dt"


def _project(df: DataFrame, mapping: dict, extra: tuple = ()) -> DataFrame:
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()], *extra)


def stage(landing: DataFrame, d: date | str | None) -> dict[str, DataFrame]:
    """The five staging frames of day ``d`` (``None``: every day, with a
    ``load_dt`` column). Lazy projections of one filtered scan; dimension
    rows carry ``create_dt`` = the transaction time."""
    if d is None:
        day = landing.where(F.col("date").isNotNull())
        extra = (F.to_date("date").alias(DAY),)
    else:
        day = landing.where(on_day("date", d))
        extra = ()
    out = {
        name: _project(day, spec.source, (F.col("date").alias("create_dt"), *extra))
        for name, spec in DIMS.items()
    }
    out["transactions"] = _project(day, FACT_SOURCE, extra)
    return out


def variants(stg: DataFrame, spec: DimSpec, by_day: bool = False) -> DataFrame:
    """Distinct attribute variants per key with their first-seen time:
    ``GROUP BY key, attrs [, load_dt]`` + ``MIN(create_dt)``.

    A hot key collapses map-side (partial aggregation) before the shuffle.
    Dimensions refuse NULL keys and attributes, so rows that hold one are left
    out (the load quarantines them with a reason)."""
    keys = [spec.key, *spec.attrs] + ([DAY] if by_day else [])
    return (stg.na.drop(subset=[spec.key, *spec.attrs])
            .groupBy(*keys)
            .agg(F.min("create_dt").alias("create_dt")))

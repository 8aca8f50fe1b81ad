"""Data-quality counts of a loaded day, stored beside its audit.

The reference's keys, foreign keys, NOT NULL columns and list-partition domains
make its load fail; here the load goes on and every violation is counted per
check, table and column in ``quality/load_dt=D``. Many days at once: :mod:`ledgerhawk.plans.quality_days`."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import REFERENCE_DOMAINS, Domains, as_date
from ..operators.keys import FACT_KEY
from ..operators.quality import domain_violations, duplicate_keys, null_violations, orphans, width_violations
from ..schemas import DIMS, NOT_NULL
from ..sources.warehouse import QUALITY, Warehouse
from .quality_days import FOREIGN_KEYS, text_widths
from .report import report_dims


def quality_counts(tables: dict[str, DataFrame], domains: Domains = REFERENCE_DOMAINS,
                   quarantine: DataFrame | None = None) -> DataFrame:
    """``check_name, table_name, column_name, n_rows`` for the dimensions, the
    fact (``transactions``) and the ``report`` of a day, zero counts included.
    ``quarantine``: rows kept out; those refused for their key count as ``duplicate_keys``."""

    def count(df: DataFrame, check: str, table: str, column: str) -> DataFrame:
        return df.agg(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                      F.lit(column).alias("column_name"), F.count(F.lit(1)).alias("n_rows"))

    def per_column(counts: DataFrame, check: str, table: str) -> DataFrame:
        name, n = counts.columns
        return counts.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                             F.col(name).alias("column_name"), F.col(n).alias("n_rows"))

    parts = [count(duplicate_keys(tables[n], [s.key]), "duplicate_keys", n, s.key) for n, s in DIMS.items()]
    twice = duplicate_keys(tables["transactions"].na.drop(subset=list(FACT_KEY)), list(FACT_KEY)).select(F.lit(1).alias("x"))
    if quarantine is not None:
        twice = twice.union(quarantine.where(F.array_contains(F.split("reason", ","), "duplicate_key")).select(F.lit(1)))
    parts.append(count(twice, "duplicate_keys", "transactions", ",".join(FACT_KEY)))
    parts += [count(orphans(tables[c], fk, tables[p], DIMS[p].key), "orphans", c, fk) for c, fk, p in FOREIGN_KEYS]
    for name, df in tables.items():
        parts += [per_column(null_violations(df, list(NOT_NULL[name])), "null", name),
                  per_column(width_violations(df, text_widths(df.schema)), "width", name)]
    parts += [count(domain_violations(tables["transactions"], c, allowed), "domain", "transactions", c)
              for c, allowed in (("oper_type", domains.oper_types), ("oper_result", domains.oper_results))]
    return reduce(DataFrame.unionByName, parts)


def quality_day(wh: Warehouse, d: date, domains: Domains = REFERENCE_DOMAINS) -> None:
    """The counts of day ``d`` into the load ``wh``."""
    wh.require_loaded(d, ("state",) if wh.mode == "scd1" else ("state", "range"))
    tables = {**report_dims(wh, d), "transactions": wh.read_fact(d), "report": wh.read_report(d)}
    counts = quality_counts(tables, domains, wh.read_quarantine(d))
    wh.write_quality(counts.select(*QUALITY.fieldNames()).coalesce(1), d)


def check_day(spark: SparkSession, root: str, d: date | str, mode: str = "scd1",
              domains: Domains = REFERENCE_DOMAINS) -> None:
    """Write and publish the counts of loaded day ``d`` (replacing an earlier run's)."""
    wh = Warehouse(spark, root, mode).begin()
    quality_day(wh, as_date(d), domains)
    wh.publish()

"""The daily driver: ETL, report and quality counts, day after day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession

from ..config import REFERENCE_DOMAINS, Domains, as_date, check_mode, default_run_ts
from ..sources.warehouse import Warehouse
from .checks import quality_day
from .etl import load_day
from .report import report_day


def days_between(start: date | str, end: date | str) -> list[date]:
    s, e = as_date(start), as_date(end)
    return [s + timedelta(days=i) for i in range((e - s).days + 1)]


def run_day(spark: SparkSession, root: str, d: date | str, mode: str = "scd1",
            run_ts: str | None = None, gate: str = "per_key",
            domains: Domains = REFERENCE_DOMAINS) -> None:
    """The ETL, the fraud report and the data-quality counts of one day as one unit:
    a single manifest publishes all their tables. If any job fails, readers keep what they
    had (also of later days), and the day is simply run again."""
    check_mode(mode, gate)
    d, run_ts = as_date(d), run_ts or default_run_ts()
    wh = Warehouse(spark, root, mode).begin()
    load_day(wh, d, run_ts, gate)
    report_day(wh, d, run_ts, domains)
    quality_day(wh, d, domains)
    wh.publish()


def run_days(spark: SparkSession, root: str, start: date | str, end: date | str,
             mode: str = "scd1", gate: str = "per_key", domains: Domains = REFERENCE_DOMAINS) -> None:
    """Replay days in order. State passes between days through the written
    snapshots, so lineage never grows across days."""
    for d in days_between(start, end):
        run_day(spark, root, d, mode, gate=gate, domains=domains)

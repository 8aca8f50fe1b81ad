"""``run_report``: the day's fraud report from the warehouse, and
``report_range``: the reports of many days in one job."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import REFERENCE_DOMAINS, Domains, as_date, default_run_ts, ts_literal
from ..operators import fraud_report, stage, variants
from ..operators.rules import DAY
from ..operators.scd import scd1_chain, with_day_validity
from ..schemas import DIMS
from ..sources.landing import BATCH_COL, landed_days, read_landing_range
from ..sources.warehouse import Warehouse, days_in
from .quality_days import recount_reports


def report_dims(wh: Warehouse, d: date) -> dict:
    """Dimensions as the report of day ``d`` sees them: the SCD1 snapshot,
    or the open SCD2 versions (``end_dt IS NULL``)."""
    if wh.mode == "scd1":
        return {n: wh.read_dim(n, d) for n in DIMS}
    return {n: wh.read_open(n, d) for n in DIMS}


def report_day(wh: Warehouse, d: date, run_ts: str, domains: Domains = REFERENCE_DOMAINS) -> None:
    """The report of day ``d`` into the load ``wh``; nothing is visible yet."""
    wh.require_loaded(d, ("state",) if wh.mode == "scd1" else ("state", "range"))
    wh.write_report(fraud_report(wh.read_fact(d), report_dims(wh, d), ts_literal(run_ts), domains), d)


def run_report(spark: SparkSession, root: str, d: date | str, mode: str = "scd1",
               run_ts: str | None = None, domains: Domains = REFERENCE_DOMAINS) -> None:
    """Write and publish the four rules' rows for day ``d``
    (replacing an earlier run of the same day, also by no rows). The day must be
    loaded; in ``scd1`` with its own stored state (else use :func:`report_range`)."""
    wh = Warehouse(spark, root, mode).begin()
    report_day(wh, as_date(d), run_ts or default_run_ts(), domains)
    wh.publish()


def report_range(spark: SparkSession, root: str, start: date | str, end: date | str,
                 mode: str = "scd2", domains: Domains = REFERENCE_DOMAINS, run_ts: str | None = None) -> None:
    """Reports of every day from ``start`` to ``end`` in one job, each
    operation joined to the dimension versions in force at the end of its
    day. ``scd2`` reads the stored history. ``scd1`` keeps none: its versions are
    the last stored snapshot before ``start`` chained with the range's batches
    (the states the daily loads had, per-key gate). The report's quality counts are
    taken anew for days that hold counts."""
    start, end = as_date(start), as_date(end)
    wh = Warehouse(spark, root, mode).begin()
    for x in landed_days(spark, root):
        if start.isoformat() <= x <= end.isoformat():
            wh.require_loaded(date.fromisoformat(x))
    if mode == "scd2":
        dims = {n: with_day_validity(wh.read_hist(n, end)) for n in DIMS}
    else:
        dims = {n: with_day_validity(_scd1_versions(wh, n, start, end)) for n in DIMS}
    fact = wh.read_fact_range(start, end).drop("trans_dt")
    rep = fraud_report(fact, dims, ts_literal(run_ts or default_run_ts()), domains, keep=(DAY,))
    rep = rep.withColumnRenamed(DAY, "load_dt")
    now = wh.manifest()
    wh.write_range(rep, "report", ["load_dt"], [x for x in days_in(start, end) if now.kind(x.isoformat())])
    recount_reports(wh, start, end, domains)
    wh.publish()


def _scd1_versions(wh: Warehouse, name: str, start: date, end: date):
    """Versions of an SCD1 dimension in force from ``start`` to ``end``."""
    spec = DIMS[name]
    snapshot = wh.read_dim_day(name, start - timedelta(days=1))
    since = start if snapshot is None else date.fromisoformat(snapshot) + timedelta(days=1)
    if snapshot is None:  # nothing stored before: from the first batch on
        first = landed_days(wh.spark, wh.root)[:1]
        since = min([start, *map(date.fromisoformat, first)])
    landing = read_landing_range(wh.spark, wh.root, since, end)
    on_day = landing.where(F.to_date("date") == F.col(BATCH_COL)).drop(BATCH_COL)
    new = variants(stage(on_day, None)[name], spec, by_day=True).drop("load_dt")
    base = wh.read_dim(name, start - timedelta(days=1))
    return scd1_chain(base, new, spec).select(*spec.columns, "start_dt", "end_dt")


__all__ = ["run_report", "report_range", "report_dims", "DAY"]

"""Command line: the reference's ``SELECT run_etl('…'); SELECT run_report('…')``
as spark-submit jobs.

    spark-submit --py-files ledgerhawk.zip submit.py run-day --root s3://wh --day 2024-01-15 --mode scd2
    python -m ledgerhawk run-day   --root ... --day 2024-01-15 --mode scd2
    python -m ledgerhawk land      --root ... --day 2024-01-15 --file t.csv --format csv
    python -m ledgerhawk backfill  --root ... --start 2024-01-01 --end 2024-01-30 --mode scd1
    python -m ledgerhawk report-range --root ... --start ... --end ... --mode scd2
    python -m ledgerhawk apply-late --root ... --mode scd2
    python -m ledgerhawk vacuum    --root ... --mode scd2 --hours 24
    python -m ledgerhawk init      --root ... --mode scd2 --database dwh

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
resources and ``spark.checkpoint.dir`` are whatever the cluster sets.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .config import FIXTURE_DOMAINS, REFERENCE_DOMAINS
from .plans.daily import days_between, run_day
from .plans.etl import backfill, run_etl
from .plans.late import apply_late
from .plans.report import report_range, run_report
from .sources.catalog import init_warehouse
from .sources.landing import land, read_daily
from .sources.warehouse import Warehouse

DOMAINS = {"reference": REFERENCE_DOMAINS, "fixture": FIXTURE_DOMAINS}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerhawk")
    sub = p.add_subparsers(dest="cmd", required=True)

    def cmd(name, *days):
        c = sub.add_parser(name)
        c.add_argument("--root", required=True, help="warehouse root (shared storage)")
        for d in days:
            c.add_argument(f"--{d}", required=True, help="YYYY-MM-DD")
        return c

    c = cmd("land", "day")
    c.add_argument("--file", required=True, nargs="+")
    c.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
    for name, days in (("run-day", ("day",)), ("run-etl", ("day",)), ("run-report", ("day",)),
                       ("backfill", ("start", "end")), ("report-range", ("start", "end"))):
        c = cmd(name, *days)
        c.add_argument("--mode", default="scd1", choices=["scd1", "scd2"])
        if name in ("run-day", "run-etl"):
            c.add_argument("--gate", default="per_key", choices=["per_key", "all_or_nothing", "literal"])
        if name != "run-etl":
            c.add_argument("--domains", default="reference", choices=sorted(DOMAINS))
        c.add_argument("--run-ts", default=None, help="timestamp recorded as report/audit time")
    c = cmd("run-days", "start", "end")
    c.add_argument("--mode", default="scd1", choices=["scd1", "scd2"])
    c.add_argument("--domains", default="reference", choices=sorted(DOMAINS))
    c = cmd("apply-late")
    c.add_argument("--mode", default="scd1", choices=["scd1", "scd2"])
    c.add_argument("--domains", default="reference", choices=sorted(DOMAINS))
    c = cmd("vacuum")
    c.add_argument("--mode", default="scd1", choices=["scd1", "scd2"])
    c.add_argument("--hours", type=float, default=24.0, help="leave versions alone that were written to since")
    c = cmd("init")
    c.add_argument("--mode", default="scd1", choices=["scd1", "scd2"])
    c.add_argument("--database", default=None)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"ledgerhawk-{a.cmd}").getOrCreate()
    dom = DOMAINS.get(getattr(a, "domains", "reference"))
    if a.cmd == "land":
        land(read_daily(spark, a.file, fmt=a.format, bad_cells=True), a.root, a.day)
    elif a.cmd == "run-day":
        run_day(spark, a.root, a.day, a.mode, a.run_ts, a.gate, dom)
    elif a.cmd == "run-etl":
        run_etl(spark, a.root, a.day, a.mode, a.run_ts, a.gate)
    elif a.cmd == "run-report":
        run_report(spark, a.root, a.day, a.mode, a.run_ts, dom)
    elif a.cmd == "run-days":
        for d in days_between(a.start, a.end):
            run_day(spark, a.root, d, a.mode, domains=dom)
    elif a.cmd == "backfill":
        backfill(spark, a.root, a.start, a.end, a.mode, a.run_ts, dom)
    elif a.cmd == "report-range":
        report_range(spark, a.root, a.start, a.end, a.mode, dom, a.run_ts)
    elif a.cmd == "apply-late":
        print(*apply_late(spark, a.root, a.mode, domains=dom))
    elif a.cmd == "vacuum":
        print(Warehouse(spark, a.root, a.mode).vacuum(a.hours))
    elif a.cmd == "init":
        for t in init_warehouse(spark, a.root, a.mode, a.database):
            print(t)
    return 0


if __name__ == "__main__":
    sys.exit(main())

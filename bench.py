"""Benchmark: the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: ``{"metric", "value", "unit", "queries": {...}, "sf"}``.
``value`` is the sum of the timed jobs. Setup (landing the fixture batches
and loading days 1-14) is timed separately and not included.

  backfill_scd1 / backfill_scd2   all 30 days of the 4 dimensions + fact + audit, one pass
  etl_day_scd1 / etl_day_scd2     run_etl of 2024-01-15 on top of days 1-14
  report_day_scd1 / report_day_scd2  run_report of 2024-01-15
  rule1..rule4_all_days           each rule over all 30 days (as-of-day dimensions)
  report_all_days                 the whole report of all 30 days in one job
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerhawk.config import FIXTURE_DOMAINS, build_session, checkpoint_dir  # noqa: E402
from ledgerhawk.operators import (  # noqa: E402
    rule_amount_probe,
    rule_city_hop,
    rule_expired_account,
    rule_expired_passport,
)
from ledgerhawk.operators.rules import day_report_dt, fraud_report  # noqa: E402
from ledgerhawk.operators.scd import with_day_validity  # noqa: E402
from ledgerhawk.plans.etl import backfill, run_etl  # noqa: E402
from ledgerhawk.plans.report import run_report  # noqa: E402
from ledgerhawk.schemas import DIMS  # noqa: E402
from ledgerhawk.sources import fixture_landing  # noqa: E402
from ledgerhawk.sources.warehouse import Warehouse  # noqa: E402

DAY = "2024-01-15"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "ledgerhawk-bench",
                          spark__sql__shuffle__partitions=str(max(2, int(cpus) * 2)),
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="lh-bench-", dir=os.environ.get("BENCH_TMP", "/tmp"))
    checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # ---- setup: land every daily batch once (not timed in value)
    t0 = time.perf_counter()
    lnd = fixture_landing(spark, sf_dir).withColumn("batch_dt", F.to_date("date"))
    lnd.write.partitionBy("batch_dt").parquet(os.path.join(scratch, "full", "landing"))
    lnd.write.partitionBy("batch_dt").parquet(os.path.join(scratch, "daily", "landing"))
    setup = time.perf_counter() - t0

    full = os.path.join(scratch, "full")
    daily = os.path.join(scratch, "daily")
    for mode in ("scd1", "scd2"):
        timed(f"backfill_{mode}", lambda m=mode: backfill(spark, full, "2024-01-01", "2024-01-30", m))
    t0 = time.perf_counter()
    for mode in ("scd1", "scd2"):
        backfill(spark, daily, "2024-01-01", "2024-01-14", mode)
    setup += time.perf_counter() - t0
    for mode in ("scd1", "scd2"):
        timed(f"etl_day_{mode}", lambda m=mode: run_etl(spark, daily, DAY, m))
        timed(f"report_day_{mode}", lambda m=mode: run_report(spark, daily, DAY, m, domains=FIXTURE_DOMAINS))

    # ---- every rule over all days, dimensions as of each operation's day
    wh = Warehouse(spark, full, "scd2")
    dims = {n: with_day_validity(wh.read_hist(n, "2024-01-30")) for n in DIMS}
    fact = wh.read_fact()
    rdt = day_report_dt()
    timed("rule1_all_days", lambda: run(rule_expired_passport(fact, dims, rdt)))
    timed("rule2_all_days", lambda: run(rule_expired_account(fact, dims, rdt)))
    timed("rule3_all_days", lambda: run(rule_city_hop(fact, dims, rdt)))
    timed("rule4_all_days", lambda: run(rule_amount_probe(fact, dims, rdt, FIXTURE_DOMAINS)))
    timed("report_all_days", lambda: run(fraud_report(fact, dims, rdt, FIXTURE_DOMAINS)))

    # ---- the same aggregates from a plain LAG window, for comparison (not in the total)
    import pyspark.sql as ps

    from ledgerhawk.operators import amount_sequence

    def plain():
        w = ps.Window.partitionBy("card_num", "day").orderBy("trans_date", "trans_id")
        f = fact.withColumn("day", F.to_date("trans_date")).withColumn("p", F.lag("amt").over(w))
        run(f.groupBy("card_num", "day").agg(F.count("*"), F.max("trans_date"), F.sum(F.when(F.col("amt") < F.col("p"), 0)
                                             .otherwise(1)), F.max_by("oper_result", F.struct("trans_date", "trans_id"))))

    sides: dict[str, list[float]] = {"plain": [], "exact": []}
    for _ in range(4):
        for side, job in (("plain", plain), ("exact", lambda: run(amount_sequence(fact, FIXTURE_DOMAINS)))):
            t0 = time.perf_counter()
            job()
            sides[side].append(time.perf_counter() - t0)
    lag_ratio = sorted(sides["exact"])[1] / sorted(sides["plain"])[1]

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "ledgerhawk_headline_jobs_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "setup_sec": round(setup, 3),
        "exact_lag_vs_plain": round(lag_ratio, 2),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

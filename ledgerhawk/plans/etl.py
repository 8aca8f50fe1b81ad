"""``run_etl``: one day's load (landing -> staging -> dimensions, fact,
audit), and ``backfill``: many days in one pass.

The four dimension merges and the fact load are independent, so they are
submitted as concurrent Spark jobs (one driver thread each); on a cluster
they share the executors, here they overlap their small stages.

A load is one unit: everything goes into a version of its own, and one manifest
makes all of it visible (:mod:`ledgerhawk.sources.manifest`). The same manifest makes every later day
stale, because its state was built on the old one. A load that fails changes nothing that readers see.

The fact has a primary key (:mod:`ledgerhawk.operators.keys`): rows with the key of an earlier
operation, of the batch or of any day before, are quarantined as ``duplicate_key``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    ACTION_INSERTED,
    ACTION_UPDATED,
    REFERENCE_DOMAINS,
    Domains,
    as_date,
    check_mode,
    configured_checkpoint_dir,
    day_start,
    default_run_ts,
    ts_literal,
)
from ..operators import audit_fact, audit_scd1, audit_scd2, scd1_upsert, scd2_step, stage, variants
from ..operators.scd import collapse_scd1, scd1_chain, scd1_upsert_literal, scd2_merge_literal, with_day_validity
from ..schemas import DIMS
from ..operators.keys import FACT_KEY, blooms, key_rows, may_hold, repeated_in
from ..schemas import FACT_SOURCE
from ..sources.landing import BATCH_COL, PLACE, landed_days, quarantined, read_landing, read_landing_range, split_late
from ..sources.warehouse import VERSION, Warehouse, days_in, list_partitions
from .quality_days import quality_by_day


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _concurrently(jobs: list) -> list:
    """Run independent Spark actions from driver threads; re-raise failures."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def _materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of a frame used twice: reliable checkpoint into the
    cluster's ``spark.checkpoint.dir`` when one is configured, otherwise the
    plan is simply recomputed (never a machine-local checkpoint)."""
    if configured_checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    return df


def load_dimension(wh: Warehouse, name: str, day_variants: DataFrame, d: date, run_ts: str,
                   gate: str = "per_key") -> DataFrame:
    """Merge one dimension for day ``d`` and write its new snapshot;
    returns the day's audit rows (counted on what was written)."""
    spec = DIMS[name]
    prev = d - timedelta(days=1)
    old = wh.before()  # inside a backfilled range, versions of the day before may be stored in the day's own old partition
    if wh.mode == "scd1":
        merge = scd1_upsert_literal if gate == "all_or_nothing" else scd1_upsert
        wh.write_dim(name, merge(old.read_dim(name, prev), day_variants, spec), d)
        return audit_scd1(wh.read_dim(name, d), name, d, run_ts)
    # Inside a backfilled range the state of the day before is rebuilt from
    # every stored version: cut the lineage first.
    first = old.starts_at(d)
    stable = first or old.open_snapshot_is_exact(name, prev)
    if not stable and not configured_checkpoint_dir(wh.spark):
        raise ValueError(f"re-running {d} inside a backfilled range needs spark.checkpoint.dir")
    if gate == "literal":
        # The reference's three statements as written (cards compare
        # account_num with card_num); the open set is rewritten whole.
        hist = wh.empty_hist(name) if first else old.read_hist(name, prev)
        hist = hist if stable else _materialize(hist)
        probe = "account_num" if name == "cards" else None
        new = scd2_merge_literal(hist, day_variants, spec, probe)
        wh.write_hist_day(name, new.where(F.col("end_dt").isNull() | (F.col("end_dt") >= day_start(d))), d)
    else:
        opened = wh.empty_hist(name) if first else old.read_open(name, prev)
        opened = opened if stable else _materialize(opened)
        wh.write_hist_day(name, scd2_step(opened, day_variants, spec), d)
    # Versions started or closed on d are all in this day's partition.
    return audit_scd2(wh.read_written_versions(name, d), name, d, run_ts)


def _landed(wh: Warehouse) -> list[str]:
    return landed_days(wh.spark, wh.root)


def known_keys(wh: Warehouse, keys: DataFrame, before: date) -> DataFrame | None:
    """The key columns of those ``keys (h, key)`` that a fact of a day before ``before`` has; None if no day can."""
    now = wh.manifest()
    days = [d for d in now.days_of("fact_blooms") if d < before.isoformat()]
    base = wh.path("fact_blooms")
    sizes = sorted({int(s) for d in days for s in list_partitions(
        wh.spark, f"{base}/load_dt={d}/{VERSION}={now.version(d, 'fact_blooms')}", "slices")})
    if not sizes:
        return None
    hits = _materialize(may_hold(keys, wh.read_fact_blooms(before), sizes))
    hit_days = sorted(r.load_dt.isoformat() for r in hits.select("load_dt").distinct().collect())  # at most the loaded days
    if not hit_days:
        return None
    return hits.join(wh.read_fact_keys(hit_days).select("load_dt", "h", *FACT_KEY), ["load_dt", "h", *FACT_KEY], "left_semi") \
        .select(*FACT_KEY).distinct()


def duplicates(wh: Warehouse, rows: DataFrame, before: date) -> DataFrame:
    """``_place`` of the landing ``rows`` whose key an earlier row of them or a fact of a day before has."""
    named = rows.select(*[F.col(src).alias(dst) for dst, src in FACT_SOURCE.items() if dst in FACT_KEY], "date", PLACE)
    found = repeated_in(named, ["date", PLACE]).select(PLACE)
    known = known_keys(wh, key_rows(named), before)
    if known is not None:
        found = found.union(named.join(known, list(FACT_KEY), "left_semi").select(PLACE)).distinct()
    return _materialize(found)


def write_key_index(wh: Warehouse, days: list[date]) -> None:
    """Sorted keys and Bloom filters of the facts that this load wrote for ``days``."""
    fact = wh.read_fact_range(min(days), max(days)).withColumnRenamed("trans_dt", "load_dt")
    keys = key_rows(fact, "load_dt").repartitionByRange("load_dt", "h").sortWithinPartitions("load_dt", "h")
    wh.write_range(keys, "fact_keys", ["load_dt"], days)
    written = wh.read_fact_keys([d.isoformat() for d in days])
    wh.write_range(blooms(written.select("h", "load_dt")), "fact_blooms", ["load_dt", "slices"], days)


def load_day(wh: Warehouse, d: date, run_ts: str, gate: str = "per_key") -> None:
    """The ETL of one day into the load ``wh`` (from :meth:`Warehouse.begin`); nothing is visible yet."""
    wh.require_previous(d, _landed(wh))
    wh.replace_days([d], {d: "state"})
    on_day, off_day = split_late(read_landing(wh.spark, wh.root, d, place=True).drop(BATCH_COL), d)
    again = duplicates(wh, on_day, d)
    stg = stage(on_day, d)
    facts = stage(on_day.join(again, PLACE, "left_anti"), d)["transactions"]
    jobs = [lambda n=n, s=s: load_dimension(wh, n, variants(stg[n], s), d, run_ts, gate)
            for n, s in DIMS.items()]

    def fact_job():
        wh.write_fact(facts, d)
        write_key_index(wh, [d])

    jobs += [fact_job, lambda: wh.write_quarantine(quarantined(on_day, off_day, again), d)]
    audits = [a for a in _concurrently(jobs) if a is not None]
    audits.append(audit_fact(wh.read_fact(d), d, run_ts))
    wh.write_audit(_union_all(audits), d)


def run_etl(spark: SparkSession, root: str, d: date | str, mode: str = "scd1",
            run_ts: str | None = None, gate: str = "per_key") -> None:
    """Load batch ``d`` from ``root/landing``: quarantine what cannot enter, merge
    the four dimensions, write the fact and the audit, and publish all of it at once.

    The batch before ``d`` must be loaded. A re-run reads the state of the day
    before and replaces the day's outputs; later days must then be run again."""
    check_mode(mode, gate)
    wh = Warehouse(spark, root, mode).begin()
    load_day(wh, as_date(d), run_ts or default_run_ts(), gate)
    wh.publish()


def backfill(spark: SparkSession, root: str, start: date | str, end: date | str,
             mode: str = "scd1", run_ts: str | None = None, domains: Domains = REFERENCE_DOMAINS) -> None:
    """Load every batch from ``start`` to ``end`` in one pass (closed form).

    Equal to running :func:`run_etl` day by day from the warehouse state of
    the day before ``start``: variants are grouped per key and day, chained
    once per key, and each day's audit is derived from the version starts
    and ends. So are its data-quality counts (``domains``: of the operations), in which the reports are
    empty until :func:`report_range` writes them. Leaves the dimension state as of ``end``; what the
    range's days held before is replaced, and later days turn stale."""
    check_mode(mode)
    start, end = as_date(start), as_date(end)
    run_ts = run_ts or default_run_ts()
    wh = Warehouse(spark, root, mode).begin()
    landed = _landed(wh)
    wh.require_previous(start, landed)
    prev = start - timedelta(days=1)
    before = {}
    for n in DIMS:  # the state of the day before; no day is replaced yet
        if mode == "scd1":
            before[n] = wh.read_dim(n, prev)
        elif wh.starts_at(start):
            before[n] = wh.empty_hist(n)
        else:
            exact = wh.open_snapshot_is_exact(n, prev)
            if not exact and not configured_checkpoint_dir(spark):
                raise ValueError(f"loading from {start} inside a backfilled range needs spark.checkpoint.dir")
            before[n] = wh.read_open(n, prev) if exact else _materialize(wh.read_open(n, prev))
    range_days = days_in(start, end)
    has_batch = {date.fromisoformat(x) for x in landed}
    wh.replace_days(range_days, {x: "range" for x in range_days if x in has_batch} | {end: "state"})
    batches = read_landing_range(spark, root, start, end, place=True)
    day = F.to_date("date")
    mine = batches.where(day == F.col(BATCH_COL))
    on_day = mine.drop(BATCH_COL)
    off_day = batches.where(day.isNull() | (day != F.col(BATCH_COL)))
    reason = (F.when(F.col("date").isNull(), F.lit("no_date"))
              .when(day < F.col(BATCH_COL), F.lit("late")).otherwise(F.lit("early")))
    again = duplicates(wh, on_day, start)
    stg = stage(on_day, None)
    facts = stage(on_day.join(again, PLACE, "left_anti"), None)["transactions"].drop("load_dt")

    def dim_job(name):
        spec = DIMS[name]
        v = variants(stg[name], spec, by_day=True).drop("load_dt")
        if mode == "scd1":
            # One chain feeds both the new snapshot and the daily audit.
            chain = _materialize(scd1_chain(before[name], v, spec))
            wh.write_dim(name, collapse_scd1(chain, spec), end)
            return _daily_audit_scd1(chain, name, start), with_day_validity(chain)
        step = scd2_step(before[name], v, spec)
        wh.write_hist_range(name, step, range_days)
        written = wh.read_hist(name, end)
        recent = (F.col("start_dt") >= day_start(start)) | (F.col("end_dt") >= day_start(start))
        return (_daily_audit_scd2(written.where(recent), name, start),
                with_day_validity(written.where(recent | F.col("end_dt").isNull())))

    def fact_job():
        wh.write_fact(facts, days=range_days)
        write_key_index(wh, range_days)

    jobs = [lambda n=n: dim_job(n) for n in DIMS]
    jobs += [fact_job, lambda: wh.write_range(quarantined(mine, off_day.withColumn("reason", reason), again)
                                              .withColumnRenamed(BATCH_COL, "load_dt"), "quarantine", ["load_dt"], range_days)]
    dims = [x for x in _concurrently(jobs) if x is not None]
    audits = [a for a, _ in dims]
    # counted on what was written, from its partition values
    fact_audit = (wh.read_fact_range(start, end).groupBy(F.col("trans_dt").alias("load_dt"))
                  .agg(F.count(F.lit(1)).alias("amount"))
                  .select(F.lit("transactions").alias("table_name"), F.lit(ACTION_INSERTED).alias("action"),
                          "amount", "load_dt"))
    audit = audit_spine(spark, range_days, _union_all(audits + [fact_audit]), run_ts)
    quality = quality_by_day({n: v for n, (_, v) in zip(DIMS, dims, strict=True)}, wh.read_fact_range(start, end), start, end,
                             domains, wh.read_quarantine_range(start, end))
    _concurrently([lambda: wh.write_range(audit, "audit", ["load_dt"], range_days),
                   lambda: wh.write_range(quality, "quality", ["load_dt"], range_days)])
    wh.publish()


def audit_spine(spark: SparkSession, days: list[date], counts: DataFrame, run_ts: str) -> DataFrame:
    """Audit rows of ``days``: every (day, table, action) gets one, zero counts included, as in a
    day-by-day run. The counts are left-joined onto a spine of the days x the fixed (table, action) pairs."""
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in days])).alias("load_dt"))
    pairs = [(n, a) for n in DIMS for a in (ACTION_INSERTED, ACTION_UPDATED)] + [("transactions", ACTION_INSERTED)]
    spine = _union_all([listed.select("load_dt", F.lit(n).alias("table_name"), F.lit(a).alias("action"))
                        for n, a in pairs])
    return spine.join(counts, ["load_dt", "table_name", "action"], "left").select(
        "table_name", "action", F.coalesce(F.col("amount"), F.lit(0)).cast("int").alias("amount"),
        ts_literal(run_ts).alias("action_date"), "load_dt")


def _audit_rows(counts: DataFrame, name: str) -> DataFrame:
    return (counts.selectExpr(
        "load_dt", f"stack(2, '{ACTION_INSERTED}', _ins, '{ACTION_UPDATED}', _upd) AS (action, amount)")
        .select(F.lit(name).alias("table_name"), "action", "amount", "load_dt"))


def _daily_audit_scd2(hist: DataFrame, name: str, start: date) -> DataFrame:
    """Per day: versions started (INSERTED) and closed (UPDATED)."""
    events = hist.select(F.explode(F.array(
        F.struct(F.to_date("start_dt").alias("load_dt"), F.lit(1).alias("_i"), F.lit(0).alias("_u")),
        F.struct(F.to_date("end_dt").alias("load_dt"), F.lit(0).alias("_i"), F.lit(1).alias("_u")),
    )).alias("e")).select("e.*").where(F.col("load_dt") >= F.lit(start))
    counts = events.groupBy("load_dt").agg(F.sum("_i").alias("_ins"), F.sum("_u").alias("_upd"))
    return _audit_rows(counts, name)


def _daily_audit_scd1(chain: DataFrame, name: str, start: date) -> DataFrame:
    """Per day, as the type 1 table stood right after that day's load:
    INSERTED = keys first seen that day; UPDATED = keys whose current
    version started that day and that have an earlier version.

    ``chain`` holds each key's stored row (``create_dt`` = its first seen
    time) and its new versions, so the first-seen time is ``min(create_dt)``."""
    spec = DIMS[name]
    per = (chain.where(F.col("start_dt") >= day_start(start))
           .groupBy(spec.key, F.to_date("start_dt").alias("load_dt"))
           .agg(F.count(F.lit(1)).alias("n_that_day")))
    firsts = chain.groupBy(spec.key).agg(F.min("create_dt").alias("first_start"))
    j = per.join(firsts, spec.key)
    is_new = F.to_date("first_start") == F.col("load_dt")
    updated = ~is_new | (F.col("n_that_day") > 1)
    counts = j.groupBy("load_dt").agg(F.count_if(is_new).alias("_ins"), F.count_if(updated).alias("_upd"))
    return _audit_rows(counts, name)

"""``apply_late``: operations that arrived with a later day's batch, put where they belong.

A daily load keeps rows of an earlier day out and quarantines them as ``late``. Here they are
landed as a part of their own day, and the days they change, and only those, get
new versions: facts, dimension states, audits, reports and quality counts are then as if the rows had
come in time (and a replay of all days would write the same).

Dimensions: for each key that a late row names, the version in force before the row's day
(its predecessor) is chained anew with everything observed from that day on. The
stored chain alone would not do: an attribute that a late row changes may have been
seen again later, which the chain does not tell. The new and the stored states of these
keys are compared day by day; a day without a difference is not written.

Only the ``per_key`` gate is supported. In ``scd1`` the days from the late ones on must have
been loaded daily, since a backfill stores no state of the days inside it. Late rows of days
before the first loaded one stay in quarantine.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import REFERENCE_DOMAINS, Domains, default_run_ts, ts_literal
from ..operators import fraud_report, stage, variants
from ..operators.keys import key_rows, may_hold
from ..operators.rules import DAY
from ..operators.scd import SRC, scd1_chain, version_chain, with_day_validity
from ..schemas import DIMS, FACT_SOURCE, DimSpec
from ..sources.landing import BATCH_COL, LANDING_COLUMNS, BAD_CELLS, PLACE, quarantined, read_landing, read_landing_range, split_late, write_batches
from ..sources.warehouse import VERSION, Warehouse, list_partitions
from .checks import quality_day
from .etl import _daily_audit_scd2, _materialize, _union_all, audit_spine, duplicates, write_key_index
from .report import _scd1_versions

#: Pseudo table in a day's manifest entry: the quarantine version whose late rows are applied.
APPLIED = "late_applied"


def pending_batches(wh: Warehouse) -> list[str]:
    """Loaded days whose quarantine may hold late rows that are not applied yet."""
    now = wh.manifest()
    return [d for d in now.days_of("quarantine")
            if now.version(d, "quarantine") != now.days[d]["tables"].get(APPLIED)]


def _late(wh: Warehouse, batches: list[str]) -> DataFrame:
    """Late rows of the batches, with their own day in ``batch_dt`` and the batch in ``load_dt``."""
    rows = wh.read_quarantine().where(F.col("load_dt").isin([date.fromisoformat(b) for b in batches]))
    return rows.where("reason = 'late'").select(*LANDING_COLUMNS, BAD_CELLS, "load_dt", F.to_date("date").alias(BATCH_COL))


def _spans(versions: DataFrame, days: list[date], first: str = "_first") -> DataFrame:
    """Each version once for every one of ``days`` it touches from its key's day ``first`` on, as ``load_dt``."""
    last = F.lit(max(days))
    until = F.least(F.coalesce(F.to_date("end_dt"), last), last)
    since = F.greatest(F.to_date("start_dt"), F.col(first))
    listed = F.array(*[F.lit(d) for d in days])
    return versions.where(since <= until).withColumn("load_dt", F.explode(F.filter(
        F.sequence(since, until), lambda d: F.array_contains(listed, d))))


def _touched(late: DataFrame, spec: DimSpec) -> DataFrame:
    """Keys that late rows name, with the first day they do."""
    return variants(stage(late, None)[spec.name], spec, by_day=True).groupBy(spec.key).agg(F.min("load_dt").alias("_first"))


def _observed(wh: Warehouse, spec: DimSpec, touched: DataFrame, start: date, end: date) -> DataFrame:
    """Every day's variants of the touched keys from their first late day on (late rows are landed by now)."""
    landing = read_landing_range(wh.spark, wh.root, start, end)
    on_day = landing.where(F.to_date("date") == F.col(BATCH_COL)).drop(BATCH_COL)
    rows = stage(on_day, None)[spec.name].join(touched, spec.key).where(F.col("load_dt") >= F.col("_first"))
    return variants(rows.drop("_first"), spec, by_day=True).drop("load_dt")


def _scd2_states(wh: Warehouse, spec: DimSpec, touched: DataFrame, days: list[date], open_days: list[date]) -> tuple[DataFrame, DataFrame]:
    """``(stored, new)`` rows of the touched keys in each day's partition, from their first late day on."""
    cols, last = [*spec.columns, "start_dt", "end_dt"], max(days)
    stored = wh.read_hist(spec.name, last).join(touched, spec.key)
    reach = stored.where(F.col("end_dt").isNull() | (F.to_date("end_dt") >= F.col("_first")))
    before = reach.where(F.to_date("start_dt") < F.col("_first")).select(*spec.columns, "start_dt", F.lit(0).alias(SRC))
    seen = _observed(wh, spec, touched, min(days), last).select(*spec.columns, F.col("create_dt").alias("start_dt"), F.lit(1).alias(SRC))
    chained = version_chain(before.unionByName(seen), spec).select(*cols).join(touched, spec.key)
    with_open = F.array(*[F.lit(d) for d in open_days])

    def partitions(versions: DataFrame) -> DataFrame:
        closes = F.to_date("end_dt") == F.col("load_dt")
        rows = _spans(versions, days).withColumn("state", F.when(closes, F.lit("closed")).otherwise(F.lit("open")))
        rows = rows.where((F.col("state") == "closed") | F.array_contains(with_open, F.col("load_dt")))
        return rows.select(*spec.columns, "start_dt", F.when(closes, F.col("end_dt")).alias("end_dt"), "load_dt", "state")

    return partitions(reach), partitions(chained)


def _scd1_states(wh: Warehouse, spec: DimSpec, touched: DataFrame, days: list[date]) -> tuple[DataFrame, DataFrame]:
    cols, last = [*spec.columns, "create_dt", "update_dt", "load_dt"], max(days)
    snapshots = wh.read_dim_days(spec.name).join(touched, spec.key)
    earlier = snapshots.where(F.col("load_dt") < F.col("_first"))
    newest = Window.partitionBy(spec.key).orderBy(F.desc("load_dt"))
    before = earlier.withColumn("_n", F.row_number().over(newest)).where("_n = 1").select(*spec.columns, "create_dt", "update_dt")
    chain = scd1_chain(before, _observed(wh, spec, touched, min(days), last), spec)
    by_key = Window.partitionBy(spec.key)
    number = F.row_number().over(by_key.orderBy("start_dt", SRC, *spec.attrs))
    chain = chain.withColumn("_first_seen", F.min("create_dt").over(by_key)).withColumn("_number", number)
    update_dt = F.when(F.col(SRC) == 0, F.col("update_dt")).when(F.col("_number") > 1, F.col("start_dt"))
    rows = _spans(chain.join(touched, spec.key), days).where(F.col("end_dt").isNull() | (F.to_date("end_dt") > F.col("load_dt")))
    new = rows.select(*spec.columns, F.col("_first_seen").alias("create_dt"), update_dt.alias("update_dt"), "load_dt")
    return snapshots.where(F.col("load_dt") >= F.col("_first")).select(*cols), new


def _rewrite_dimension(wh: Warehouse, name: str, late: DataFrame, days: list[date], open_days: list[date]) -> set[date]:
    """Write the days of one dimension that the late rows change; returns them."""
    spec = DIMS[name]
    touched = _materialize(_touched(late, spec))
    stored, new = (_scd2_states(wh, spec, touched, days, open_days) if wh.mode == "scd2"
                   else _scd1_states(wh, spec, touched, days))
    stored, new = _materialize(stored), _materialize(new)
    changed = stored.exceptAll(new).union(new.exceptAll(stored).select(*stored.columns))
    dirty = sorted(r.load_dt for r in changed.select("load_dt").distinct().collect())  # at most the loaded days
    if not dirty:
        return set()
    every = wh.read_dim_days(name) if wh.mode == "scd1" else wh.read_hist_parts(name)
    same = every.where(F.col("load_dt").isin(dirty)).join(touched, spec.key, "left") \
        .where(F.col("_first").isNull() | (F.col("load_dt") < F.col("_first"))).select(*new.columns)
    table, parts = (f"dim_{name}", ["load_dt"]) if wh.mode == "scd1" else (f"dim_{name}_hist", ["load_dt", "state"])
    wh.write_range(_materialize(same).unionByName(new.where(F.col("load_dt").isin(dirty))), table, parts, dirty)
    return set(dirty)


def _days_holding(wh: Warehouse, late: DataFrame, after: date) -> set[date]:
    """Loaded days later than ``after`` whose facts may have the key of a late row: it now comes first."""
    now = wh.manifest()
    keys = key_rows(late.select(*[F.col(src).alias(dst) for dst, src in FACT_SOURCE.items()]))
    days = [d for d in now.days_of("fact_blooms") if d > after.isoformat()]
    sizes = sorted({int(s) for d in days for s in list_partitions(
        wh.spark, f"{wh.path('fact_blooms')}/load_dt={d}/{VERSION}={now.version(d, 'fact_blooms')}", "slices")})
    if not sizes:
        return set()
    hits = may_hold(keys, wh.read_fact_blooms().where(F.col("load_dt") > F.lit(after)), sizes)
    return {r.load_dt for r in hits.select("load_dt").distinct().collect()}


def apply_late(spark: SparkSession, root: str, mode: str = "scd2", run_ts: str | None = None,
               domains: Domains = REFERENCE_DOMAINS) -> list[date]:
    """Put all late rows in quarantine where they belong and publish the days that
    change, at once; returns those days. Applying twice changes nothing."""
    run_ts = run_ts or default_run_ts()
    wh = Warehouse(spark, root, mode).begin()
    now = wh.manifest()
    batches = pending_batches(wh)
    loaded = [date.fromisoformat(d) for d in sorted(now.days) if now.kind(d) in ("state", "range")]
    found = _late(wh, batches).where(F.col(BATCH_COL).isin(loaded)) if batches and loaded else None
    own = sorted((r.load_dt, r[BATCH_COL]) for r in found.select("load_dt", BATCH_COL).distinct().collect()) if found is not None else []
    for d in batches:
        wh.note(d, APPLIED, now.version(d, "quarantine"))
    if not own:
        wh.publish()
        return []
    first = min(d for _, d in own)
    days = [d for d in loaded if d >= first]
    if mode == "scd1" and any(now.kind(d.isoformat()) == "range" for d in [x for x in loaded if x < first][-1:] + days):
        raise ValueError(f"scd1: a day from {first} on lies inside a backfilled range, whose states are not stored; run the backfill again")
    late = _materialize(found)
    for batch in sorted({b for b, _ in own}):
        rows = late.where(F.col("load_dt") == F.lit(batch)).drop("load_dt")
        write_batches(rows, root, [d for b, d in own if b == batch], f"late-{batch}")
    late = late.drop(BATCH_COL, "load_dt")
    fact_days = {d for _, d in own}
    fact_days |= {d for d in _days_holding(wh, late, first) if d in days}
    open_days = [d for d in days if now.kind(d.isoformat()) == "state"]
    dirty = set(fact_days)
    for name in DIMS:
        dirty |= _rewrite_dimension(wh, name, late, days, open_days)
    for d in sorted(fact_days):  # in order: a day's keys depend on the days before
        on_day, off_day = split_late(read_landing(spark, root, d, place=True).drop(BATCH_COL), d)
        again = duplicates(wh, on_day, d)
        wh.write_fact(stage(on_day.join(again, PLACE, "left_anti"), d)["transactions"], d)
        write_key_index(wh, [d])
        wh.write_quarantine(quarantined(on_day, off_day, again), d)
        wh.note(d, APPLIED, wh.load)
    _rewrite_audits(wh, sorted(dirty), run_ts)
    _rewrite_reports(wh, sorted(dirty), run_ts, domains)
    for d in sorted(dirty):
        if now.version(d.isoformat(), "quality"):
            quality_day(wh, d, domains)
    wh.publish()
    return sorted(dirty)


def _rewrite_audits(wh: Warehouse, days: list[date], run_ts: str) -> None:
    """The audits of ``days`` from the states as they are now."""
    counts = []
    for name in DIMS:
        if wh.mode == "scd2":
            counts.append(_daily_audit_scd2(wh.read_hist(name, max(days)), name, min(days)))
        else:
            per_day = wh.read_dim_days(name).groupBy("load_dt").agg(
                F.count_if(F.to_date("create_dt") == F.col("load_dt")).alias("INSERTED"),
                F.count_if(F.to_date("update_dt") == F.col("load_dt")).alias("UPDATED"))
            counts.append(per_day.unpivot(["load_dt"], ["INSERTED", "UPDATED"], "action", "amount")
                          .select(F.lit(name).alias("table_name"), "action", "amount", "load_dt"))
    fact = wh.read_fact_range(min(days), max(days)).groupBy(F.col("trans_dt").alias("load_dt")).agg(F.count(F.lit(1)).alias("amount"))
    counts.append(fact.select(F.lit("transactions").alias("table_name"), F.lit("INSERTED").alias("action"), "amount", "load_dt"))
    wh.write_range(audit_spine(wh.spark, days, _union_all(counts), run_ts), "audit", ["load_dt"], days)


def _rewrite_reports(wh: Warehouse, days: list[date], run_ts: str, domains: Domains) -> None:
    """The reports of those of ``days`` that had one."""
    base = wh.base
    days = [d for d in days if base.version(d.isoformat(), "report")]
    if not days:
        return
    if wh.mode == "scd2":
        dims = {n: with_day_validity(wh.read_hist(n, max(days))) for n in DIMS}
    else:
        dims = {n: with_day_validity(_scd1_versions(wh, n, min(days), max(days))) for n in DIMS}
    fact = wh.read_fact_range(min(days), max(days)).where(F.col("trans_dt").isin(days)).drop("trans_dt")
    report = fraud_report(fact, dims, ts_literal(run_ts), domains, keep=(DAY,)).withColumnRenamed(DAY, "load_dt")
    wh.write_range(report, "report", ["load_dt"], days)


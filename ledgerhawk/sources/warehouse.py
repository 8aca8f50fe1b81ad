"""Warehouse tables on Parquet: paths, schemas, snapshot reads and day-partitioned
writes that become visible all at once.

Parquet has no in-place UPDATE/MERGE, so dimension state is a snapshot per
load day: a day's job reads the snapshot of the previous day and writes a new one.
A load (:meth:`Warehouse.begin`) writes every table into a version of its own and
publishes all of them with one manifest (:mod:`manifest`): until then, and for good
if it fails, readers see what they saw before. Published versions are never written
again, so a day can be re-run while its old rows are being read. Loading a day makes every later
day stale: its facts, reports, audits and counts are no longer returned, and jobs that
need it refuse to run until it is loaded again. Layout under ``root/<mode>/``, each
day directory holding a ``load=<version>`` directory per load::

    dim_<name>/load_dt=D/                 SCD1 snapshot after day D
    dim_<name>_hist/load_dt=D/../state=open    SCD2 open versions after day D
    dim_<name>_hist/load_dt=D/../state=closed  versions closed on day D (append-only history)
    fact_transactions/trans_dt=D/../oper_type=/oper_result=
    fact_keys/load_dt=D                   hashed keys of the day's facts, sorted
    fact_blooms/load_dt=D                 Bloom filters over them
    report/load_dt=D
    audit/load_dt=D
    quarantine/load_dt=D                  landing rows kept out, with the reason
    quality/load_dt=D                     counts of the day's data-quality checks
    _manifest/<number>.json               the versions that readers see
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructField, StructType, TimestampNTZType

from ..config import as_date, check_mode
from ..schemas import AUDIT, DIMS, LANDING, REPORT, DimSpec
from .manifest import Manifest, hadoop_path, latest, publish

TS = TimestampNTZType()
VERSION = "load"
QUALITY = StructType([StructField("check_name", StringType()), StructField("table_name", StringType()),
                      StructField("column_name", StringType()), StructField("n_rows", LongType())])
QUARANTINE_REASON = StructField("reason", StringType())
FACT_KEYS = StructType([StructField("h", LongType()), StructField("trans_id", StringType()),
                        StructField("oper_type", StringType()), StructField("oper_result", StringType())])
FACT_BLOOMS = StructType([StructField("slices", LongType()), StructField("slice", LongType()),
                          StructField("bits", ArrayType(LongType()))])


def dim_schema(spec: DimSpec, mode: str) -> StructType:
    base = {f.name: f.dataType for f in LANDING.fields}
    fields = [StructField(c, base[src]) for c, src in spec.source.items()]
    extra = ("create_dt", "update_dt") if mode == "scd1" else ("start_dt", "end_dt")
    return StructType(fields + [StructField(c, TS) for c in extra])


def fact_schema() -> StructType:
    from ..schemas import FACT_SOURCE
    base = {f.name: f.dataType for f in LANDING.fields}
    return StructType([StructField(c, base[src]) for c, src in FACT_SOURCE.items()])


def list_partitions(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of ``col=`` sub-directories under ``path`` (a metadata listing
    on the driver through the Hadoop FileSystem of the path)."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(col + "="):
            out.append(name.split("=", 1)[1])
    return sorted(out)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def days_in(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def iso(d: date | str) -> str:
    return as_date(d).isoformat()


@dataclass(frozen=True)
class Warehouse:
    """A reader of the newest manifest; as returned by :meth:`begin`, also a load in progress,
    which reads what it has written over what was there when it began."""

    spark: SparkSession
    root: str
    mode: str = "scd1"
    #: Of a load in progress: its version, the manifest it began on, and its days' entries so far.
    load: str | None = None
    base: Manifest | None = None
    pending: dict[str, dict] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.mode}/{table}"

    def __post_init__(self) -> None:
        check_mode(self.mode)

    # ---------------------------------------------------------- loads

    def manifest(self) -> Manifest:
        if self.load is None:
            return latest(self.spark, self.path("_manifest"))
        days = dict(self.base.days)
        for d, e in self.pending.items():
            old = days.get(d, {"kind": "stale", "tables": {}})
            days[d] = {"kind": e["kind"] or old["kind"], "tables": {**({} if e["anew"] else old["tables"]), **e["tables"]}}
        return Manifest(self.base.number, days)

    def begin(self) -> Warehouse:
        """A load: writes go to a new version; :meth:`publish` makes them visible."""
        return replace(self, load=uuid.uuid4().hex[:16], base=self.manifest(), pending={})

    def before(self) -> Warehouse:
        """What readers saw when this load began: also what the days that it replaces held."""
        return replace(self, pending={})

    def _write_version(self, days: list[date | str], table: str) -> str:
        if self.load is None:
            raise ValueError("tables are written by a load: call begin() first")
        for d in days:
            self.pending.setdefault(iso(d), {"kind": None, "anew": False, "tables": {}})["tables"][table] = self.load
        return self.load

    def note(self, d: date | str, table: str, version: str) -> None:
        """Put ``table``'s ``version`` into the day's entry without writing rows."""
        self.pending.setdefault(iso(d), {"kind": None, "anew": False, "tables": {}})["tables"][table] = version

    def replace_days(self, days: list[date], kinds: dict[date, str]) -> None:
        """The load makes ``days`` anew: what they held is dropped, and every later day turns stale."""
        for d in days:
            self.pending[iso(d)] = {"kind": kinds.get(d, "none"), "anew": True, "tables": {}}
        last = iso(max(days))
        for d, e in self.base.days.items():
            if d > last and e["kind"] != "stale":
                self.pending[d] = {"kind": "stale", "anew": False, "tables": {}}

    def publish(self) -> None:
        """One rename: from now on readers see all tables of this load."""
        days = {d: e for d, e in self.manifest().days.items() if e["tables"]}
        publish(self.spark, self.path("_manifest"), self.base, days)

    def vacuum(self, older_than_hours: float = 24.0) -> int:
        """Delete version directories that no manifest names and that nothing wrote to for a while
        (of broken-off loads, and replaced ones); returns how many."""
        now, gone = latest(self.spark, self.path("_manifest")), 0
        before = (time.time() - 3600 * older_than_hours) * 1000
        for table, col in self.tables().items():
            for day in list_partitions(self.spark, self.path(table), col):
                for version in list_partitions(self.spark, f"{self.path(table)}/{col}={day}", VERSION):
                    fs, p = hadoop_path(self.spark, f"{self.path(table)}/{col}={day}/{VERSION}={version}")
                    if now.version(day, table) != version and fs.getFileStatus(p).getModificationTime() <= before:
                        fs.delete(p, True)
                        gone += 1
        return gone

    def tables(self) -> dict[str, str]:
        """Every table and its day column."""
        dims = [f"dim_{n}" if self.mode == "scd1" else f"dim_{n}_hist" for n in DIMS]
        return {"fact_transactions": "trans_dt"} | dict.fromkeys(
            [*dims, "fact_keys", "fact_blooms", "report", "audit", "quarantine", "quality"], "load_dt")

    def loaded_as(self, d: date | str) -> str | None:
        """``state``: day ``d`` is loaded and the dimensions are stored as of its end;
        ``range``: loaded inside a backfill; None: not loaded, or stale since an
        earlier day was loaded again."""
        kind = self.manifest().kind(iso(d))
        return kind if kind in ("state", "range") else None

    def require_previous(self, d: date, landed: list[str]) -> None:
        """Raise unless the batch before ``d`` is loaded and its state can be read."""
        before = [x for x in landed if x < d.isoformat()]
        if not before:
            return
        kind = self.loaded_as(before[-1])
        if kind is None or (kind == "range" and self.mode == "scd1"):
            raise ValueError(f"{self.mode}: the batch of {before[-1]} is not loaded, or no state of that day is stored "
                             f"(inside a backfilled range); load it before {d}, or run the backfill again")

    def starts_at(self, d: date) -> bool:
        """Whether no day before ``d`` is loaded: the state before it is empty."""
        now = self.manifest()
        return not [x for x in now.days if x < d.isoformat() and now.kind(x) in ("state", "range")]

    def require_loaded(self, d: date, kinds: tuple[str, ...] = ("state", "range")) -> None:
        if self.loaded_as(d) not in kinds:
            raise ValueError(f"{self.mode}: day {d} is not loaded, is invalid since an earlier day was loaded "
                             f"again, or lies inside a backfilled range without its own state")

    # ---------------------------------------------------------- reading and writing versions

    def _empty(self, schema: StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _read(self, table: str, col: str, schema: StructType, days: list[str], now: Manifest) -> DataFrame:
        """Rows of ``days`` in the versions of the manifest: only their directories are listed.
        A table-wide read filtered on the column would first list every file of every partition."""
        full = StructType([*schema.fields, StructField(col, DateType())])
        base = self.path(table)
        paths = [p for p in (f"{base}/{col}={d}/{VERSION}={now.version(d, table)}" for d in days) if path_exists(self.spark, p)]
        if not paths:
            return self._empty(full)
        stored = StructType([*full.fields, StructField(VERSION, StringType())])
        return self.spark.read.schema(stored).option("basePath", base).parquet(*paths).drop(VERSION)

    def _read_days(self, table: str, col: str, schema: StructType, start: date | None, end: date | None,
                   stale: bool = False) -> DataFrame:
        now = self.manifest()
        days = [x for x in now.days_of(table, stale)
                if (start is None or x >= start.isoformat()) and (end is None or x <= end.isoformat())]
        return self._read(table, col, schema, days, now)

    def _read_day(self, table: str, col: str, schema: StructType, d: date | str | None) -> DataFrame:
        day = None if d is None else as_date(d)
        return self._read_days(table, col, schema, day, day)

    def _write_day(self, df: DataFrame, table: str, col: str, d: date | str, parts: tuple[str, ...] = ()) -> None:
        """One day's rows into this load's version (none: an empty table)."""
        version = self._write_version([d], table)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts)
         .parquet(f"{self.path(table)}/{col}={iso(d)}/{VERSION}={version}"))

    def write_range(self, df: DataFrame, table: str, parts: list[str], days: list[date]) -> None:
        """Rows of many ``days`` in one job (``parts``: the day column first). The rebalance
        splits large partitions and puts small ones into one file each."""
        version = self._write_version(days, table)
        (df.hint("rebalance", *parts).withColumn(VERSION, F.lit(version))
         .write.mode("append").partitionBy(parts[0], VERSION, *parts[1:]).parquet(self.path(table)))

    # ---------------------------------------------------------- dimensions

    def empty_hist(self, name: str) -> DataFrame:
        return self._empty(dim_schema(DIMS[name], "scd2"))

    def read_written_versions(self, name: str, d: date) -> DataFrame:
        """What day ``d``'s SCD2 job wrote: versions started, closed or still open."""
        return self._read_hist_days(name, [iso(d)], self.manifest())

    def _read_hist_days(self, name: str, days: list[str], now: Manifest) -> DataFrame:
        stored = StructType(dim_schema(DIMS[name], "scd2").fields + [StructField("state", StringType())])
        return self._read(f"dim_{name}_hist", "load_dt", stored, days, now)

    def read_dim_day(self, name: str, upto: date | str) -> str | None:
        """Day of the SCD1 snapshot that holds the state at ``upto``, if any."""
        days = [d for d in self.manifest().days_of(f"dim_{name}") if d <= iso(upto)]
        return days[-1] if days else None

    def read_dim(self, name: str, upto: date | str) -> DataFrame:
        """SCD1 snapshot as of the end of day ``upto`` (empty if none)."""
        spec, schema = DIMS[name], dim_schema(DIMS[name], "scd1")
        day = self.read_dim_day(name, upto)
        if day is None:
            return self._empty(schema)
        return self._read(f"dim_{name}", "load_dt", schema, [day], self.manifest()).select(
            *spec.columns, "create_dt", "update_dt")

    def read_dim_days(self, name: str) -> DataFrame:
        """Every day's SCD1 snapshot, with the day as ``load_dt``."""
        return self._read_days(f"dim_{name}", "load_dt", dim_schema(DIMS[name], "scd1"), None, None)

    def read_hist_parts(self, name: str) -> DataFrame:
        """Every stored SCD2 row with its ``load_dt`` and ``state`` (open snapshots repeat from day to day)."""
        return self._read_hist_days(name, self.manifest().days_of(f"dim_{name}_hist"), self.manifest())

    def write_dim(self, name: str, df: DataFrame, d: date | str) -> None:
        self._write_day(df, f"dim_{name}", "load_dt", d)

    def _open_snapshot_day(self, table: str, upto: date, now: Manifest) -> tuple[str | None, bool]:
        """Latest day <= ``upto`` holding an open snapshot, and whether it
        alone gives the state at ``upto`` (no later partition up to then).
        Versions of stale days still count here: they hold what closed there."""
        stored = now.days_of(table, stale=True)
        days = [d for d in stored if d <= upto.isoformat()]
        for i in range(len(days) - 1, -1, -1):
            states = list_partitions(self.spark, f"{self.path(table)}/load_dt={days[i]}/{VERSION}={now.version(days[i], table)}", "state")
            # a finished daily run may leave no open version at all
            if "open" in states or now.kind(days[i]) == "state":
                return days[i], i == len(days) - 1
        return None, not stored

    def open_snapshot_is_exact(self, name: str, upto: date | str) -> bool:
        """Whether the state at ``upto`` is a stored open snapshot (else it is
        rebuilt from every stored version, which may include later days)."""
        return self._open_snapshot_day(f"dim_{name}_hist", as_date(upto), self.manifest())[1]

    def read_open(self, name: str, upto: date | str) -> DataFrame:
        """SCD2 open versions as of the end of day ``upto``: the day's open
        snapshot when there is one (daily runs write one per day), otherwise
        rebuilt from the full history (after a backfill only its last day
        has a snapshot)."""
        spec, upto, now = DIMS[name], as_date(upto), self.manifest()
        day, exact = self._open_snapshot_day(f"dim_{name}_hist", upto, now)
        if day is None and exact:
            return self.empty_hist(name)
        if not exact:
            return self._rebuilt(name, upto, now).where(F.col("end_dt").isNull())
        return self._read_hist_days(name, [day], now).where("state = 'open'").select(*spec.columns, "start_dt", "end_dt")

    def _rebuilt(self, name: str, upto: date, now: Manifest) -> DataFrame:
        """History as of ``upto`` from every stored version (any layout)."""
        spec = DIMS[name]
        days = now.days_of(f"dim_{name}_hist", stale=True)
        last_open, _ = self._open_snapshot_day(f"dim_{name}_hist", date.fromisoformat(days[-1]), now)
        live = F.col("state") == "closed"
        if last_open is not None:
            live |= (F.col("state") == "open") & (F.col("load_dt") == F.lit(date.fromisoformat(last_open)))
        every = self._read_hist_days(name, days, now).where(live).select(*spec.columns, "start_dt", "end_dt")
        hi = F.lit((upto + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
        return every.where(F.col("start_dt") < hi).withColumn(
            "end_dt", F.when(F.col("end_dt") < hi, F.col("end_dt")))

    def read_hist(self, name: str, upto: date | str) -> DataFrame:
        """Full SCD2 history as of the end of day ``upto``: the open
        snapshot plus every closed partition up to that day (pruned)."""
        spec, upto, now = DIMS[name], as_date(upto), self.manifest()
        day, exact = self._open_snapshot_day(f"dim_{name}_hist", upto, now)
        if day is None and exact:
            return self.empty_hist(name)
        if not exact:
            return self._rebuilt(name, upto, now)
        days = [d for d in now.days_of(f"dim_{name}_hist", stale=True) if d <= upto.isoformat()]
        live = (F.col("state") == "closed") | (F.col("load_dt") == F.lit(date.fromisoformat(day)))
        return self._read_hist_days(name, days, now).where(live).select(*spec.columns, "start_dt", "end_dt")

    def write_hist_day(self, name: str, step: DataFrame, d: date | str) -> None:
        """One write for a day's SCD2 result: rows still open go to
        ``state=open`` (the new snapshot), rows closed that day to
        ``state=closed``."""
        state = F.when(F.col("end_dt").isNull(), F.lit("open")).otherwise(F.lit("closed"))
        self._write_day(step.withColumn("state", state), f"dim_{name}_hist", "load_dt", d, ("state",))

    def write_hist_range(self, name: str, hist: DataFrame, days: list[date]) -> None:
        """One write for a multi-day result: each version closed before the last of
        ``days`` goes under the day it closed (``state=closed``); open
        versions and those closed on the last day form its snapshot."""
        hist = (hist.withColumn("load_dt", F.coalesce(F.to_date("end_dt"), F.lit(max(days))))
                .withColumn("state", F.when(F.col("end_dt").isNull(), F.lit("open")).otherwise(F.lit("closed"))))
        self.write_range(hist, f"dim_{name}_hist", ["load_dt", "state"], days)

    # ---------------------------------------------------------- fact, report, audit

    def write_fact(self, stg_tx: DataFrame, d: date | str | None = None, days: list[date] | None = None) -> None:
        """Fact rows partitioned by day, then operation type and result (the
        reference's two-level list partitions under a day level): one day, or
        (``d`` None) the ``days`` of a range."""
        parts = ("oper_type", "oper_result")
        if d is None:
            self.write_range(stg_tx.withColumn("trans_dt", F.to_date("trans_date")), "fact_transactions",
                             ["trans_dt", *parts], days)
        else:
            self._write_day(stg_tx.hint("rebalance", *parts), "fact_transactions", "trans_dt", d, parts)

    def read_fact(self, d: date | str | None = None) -> DataFrame:
        return self._read_day("fact_transactions", "trans_dt", fact_schema(), d).select(*fact_schema().fieldNames())

    def read_fact_range(self, start: date | None, end: date | None) -> DataFrame:
        """Fact rows of the days from ``start`` to ``end``: only their directories are listed."""
        return self._read_days("fact_transactions", "trans_dt", fact_schema(), start, end)

    def write_report(self, report: DataFrame, d: date | str) -> None:
        self._write_day(report.select(*REPORT.fieldNames()), "report", "load_dt", d)

    def read_report(self, d: date | str | None = None) -> DataFrame:
        return self._read_day("report", "load_dt", REPORT, d)

    def read_report_range(self, start: date, end: date) -> DataFrame:
        return self._read_days("report", "load_dt", REPORT, start, end)

    def write_audit(self, audit: DataFrame, d: date | str) -> None:
        # 9 rows a day: one file (sub-partitions by table and action would only make tiny ones)
        self._write_day(audit.select(*AUDIT.fieldNames()).coalesce(1), "audit", "load_dt", d)

    def read_audit(self, d: date | str | None = None) -> DataFrame:
        return self._read_day("audit", "load_dt", AUDIT, d)

    def write_quality(self, counts: DataFrame, d: date | str) -> None:
        self._write_day(counts, "quality", "load_dt", d)

    def read_quality(self, d: date | str | None = None) -> DataFrame:
        return self._read_day("quality", "load_dt", QUALITY, d)

    def read_quality_range(self, start: date, end: date) -> DataFrame:
        return self._read_days("quality", "load_dt", QUALITY, start, end)

    def write_quarantine(self, rows: DataFrame, d: date | str) -> None:
        self._write_day(rows, "quarantine", "load_dt", d)

    def read_quarantine(self, d: date | str | None = None) -> DataFrame:
        day = None if d is None else as_date(d)
        return self.read_quarantine_range(day, day)

    def read_quarantine_range(self, start: date | None, end: date | None) -> DataFrame:
        from .landing import BAD_CELLS_FIELD
        return self._read_days("quarantine", "load_dt", StructType([*LANDING.fields, BAD_CELLS_FIELD, QUARANTINE_REASON]), start, end)

    # ---------------------------------------------------------- keys of the facts

    def write_fact_keys(self, keys: DataFrame, d: date | str) -> None:
        self._write_day(keys, "fact_keys", "load_dt", d)

    def write_fact_blooms(self, blooms: DataFrame, d: date | str) -> None:
        self._write_day(blooms, "fact_blooms", "load_dt", d)

    def read_fact_keys(self, days: list[str]) -> DataFrame:
        return self._read("fact_keys", "load_dt", FACT_KEYS, days, self.manifest())

    def read_fact_blooms(self, before: date | None = None) -> DataFrame:
        """Bloom filters of the days (before ``before``), with the day as ``load_dt``."""
        end = None if before is None else before - timedelta(days=1)
        return self._read_days("fact_blooms", "load_dt", FACT_BLOOMS, None, end)

"""Constants, domains and session helpers.

Everything that must equal the reference's values for right results is
kept together below under "Fixed values".
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference) ---------------------------------
# Report fraud types, rules 1-4 in order.
FRAUD_EXPIRED_PASSPORT = "Совершение операции при просроченном паспорте"
FRAUD_EXPIRED_ACCOUNT = "Совершение операции при недействующем договоре"
FRAUD_CITY_HOP = "Совершение операции в разных городах в течение 1 часа"
FRAUD_AMOUNT_PROBE = "Попытка подбора сумм"
# Operation domains of the fact table (oper_type, then oper_result).
REFERENCE_OPER_TYPES = ("Снятие", "Пополнение", "Оплата")
REFERENCE_SUCCESS = "Успешно"
REFERENCE_REFUSED = "Отказ"
# Audit actions.
ACTION_INSERTED = "INSERTED"
ACTION_UPDATED = "UPDATED"
# Rule thresholds: rule 3 gap is inclusive, rule 4 needs more than 3 operations.
CITY_HOP_MAX_GAP_SECONDS = 3600
AMOUNT_PROBE_MIN_OPS_EXCLUSIVE = 3
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Domains:
    """Value domains of the operation columns (configurable: the driver's
    fixture tables use English stand-ins)."""

    oper_types: tuple[str, ...] = REFERENCE_OPER_TYPES
    success: str = REFERENCE_SUCCESS
    refused: str = REFERENCE_REFUSED

    @property
    def oper_results(self) -> tuple[str, ...]:
        return (self.success, self.refused)


REFERENCE_DOMAINS = Domains()
FIXTURE_DOMAINS = Domains(
    oper_types=("withdrawal", "refill", "payment"), success="success", refused="refused"
)


def as_date(d: date | str) -> date:
    """Parse the load-day parameter once: a date, or text ``Y-M-D`` with or
    without zero padding (``'2020-05-01'``, ``'2020-5-1'``), optionally
    followed by a time, which is ignored."""
    if isinstance(d, datetime):
        return d.date()
    if isinstance(d, date):
        return d
    text = str(d).strip().split("T")[0].split(" ")[0]
    y, m, dd = (int(x) for x in text.split("-"))
    return date(y, m, dd)


def day_start(d: date | str) -> Column:
    """``timestamp_ntz`` literal for 00:00 of day ``d`` (no time zone involved)."""
    return F.lit(as_date(d).isoformat()).cast("timestamp_ntz")


def day_end(d: date | str) -> Column:
    """Exclusive upper bound: 00:00 of the following day."""
    return F.lit((as_date(d) + timedelta(days=1)).isoformat()).cast("timestamp_ntz")


def ts_literal(ts: str | datetime) -> Column:
    """A ``timestamp_ntz`` literal from ISO text, used for run timestamps."""
    text = ts.isoformat(sep=" ") if isinstance(ts, datetime) else str(ts)
    return F.lit(text).cast("timestamp_ntz")


def default_run_ts(d: date | str | None = None) -> str:
    """The run's own time (UTC): one value for everything a job writes."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


GATES = {"scd1": ("per_key", "all_or_nothing"), "scd2": ("per_key", "literal")}


def check_mode(mode: str, gate: str = "per_key") -> None:
    """Raise on a mode or insert gate that does not exist (in that mode)."""
    if mode not in GATES:
        raise ValueError(f"mode must be one of {sorted(GATES)}, not {mode!r}")
    if gate not in GATES[mode]:
        raise ValueError(f"gate of {mode} must be one of {GATES[mode]}, not {gate!r}")


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir`` (installed on the context if needed), or None."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        sc.setCheckpointDir(current)
    return current


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Like :func:`configured_checkpoint_dir`; only when the session names
    none (tests, local runs) is ``fallback`` installed."""
    current = configured_checkpoint_dir(spark)
    if current:
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def build_session(master: str = "local[*]", app: str = "ledgerhawk", **conf: str) -> SparkSession:
    """Session with the settings the engine is tuned for (AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()

"""Slowly changing dimensions, type 1 (overwrite) and type 2 (history).

One generic operator per type, driven by a :class:`DimSpec`, replaces the
reference's four hand-written copies. Both the daily (incremental) merge and
the whole-history backfill are built on the same *version chain*: candidate
rows of a key ordered by time, keeping the first and every row whose
attributes differ (``<>``) from the row before. Each key's chain holds only
distinct variants (one per change), never raw transactions, so a hot key
does not make a big window partition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import day_end
from ..functions import changed
from ..schemas import DimSpec
from .staging import DAY

SRC = "_src"  # 0 = stored version, 1 = new variant (stored first on ties)


def version_chain(cands: DataFrame, spec: DimSpec) -> DataFrame:
    """Keep the first candidate of each key and every candidate whose
    attributes changed; ``end_dt`` = start of the next kept version."""
    w = Window.partitionBy(spec.key).orderBy("start_dt", SRC, *spec.attrs)
    marked = cands.select("*", (F.row_number().over(w) == 1).alias("_first"),
                          *[F.lag(a).over(w).alias(f"_p_{a}") for a in spec.attrs])
    prev = [F.col(f"_p_{a}") for a in spec.attrs]
    cur = [F.col(a) for a in spec.attrs]
    kept = marked.where(F.col("_first") | changed(prev, cur)).drop("_first", *[f"_p_{a}" for a in spec.attrs])
    return kept.withColumn("end_dt", F.lead("start_dt").over(w))


def split_touched(stored: DataFrame, day_variants: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows whose key has new variants, and the rest.

    Untouched rows pass through unchanged, so the version chain (a shuffle
    on the key) only sees the touched keys. The day's key set is usually far
    smaller than the dimension: when Spark (or AQE at run time) finds it
    small enough to broadcast, the stored rows are filtered in place and
    never shuffled; otherwise both joins share one exchange."""
    keys = day_variants.select(key).distinct()
    return stored.join(keys, key, "left_semi"), stored.join(keys, key, "left_anti")


# ----------------------------------------------------------------- SCD type 2

def current(hist: DataFrame) -> DataFrame:
    """Open versions (``end_dt IS NULL``)."""
    return hist.where(F.col("end_dt").isNull())


def scd2_step(open_rows: DataFrame, day_variants: DataFrame, spec: DimSpec) -> DataFrame:
    """Chain the open versions with one day's (or several days') variants.

    Result rows: open versions that stay open, open versions closed
    (``end_dt`` = first-seen time of the changed variant) and the new
    versions (changed keys and unseen keys). Closed history is untouched and
    not read; open versions of keys without variants pass through."""
    touched, untouched = split_touched(open_rows, day_variants, spec.key)
    stored = touched.select(*spec.columns, "start_dt", F.lit(0).alias(SRC))
    new = day_variants.select(*spec.columns, F.col("create_dt").alias("start_dt"), F.lit(1).alias(SRC))
    chained = version_chain(stored.unionByName(new), spec).select(*spec.columns, "start_dt", "end_dt")
    return untouched.select(*spec.columns, "start_dt", "end_dt").unionByName(chained)


def scd2_merge(hist: DataFrame, day_variants: DataFrame, spec: DimSpec) -> DataFrame:
    """Full history after one day's load: closed rows ∪ :func:`scd2_step`."""
    closed = hist.where(F.col("end_dt").isNotNull()).select(*spec.columns, "start_dt", "end_dt")
    return closed.unionByName(scd2_step(current(hist), day_variants, spec))


def scd2_backfill(stg_all: DataFrame, spec: DimSpec) -> DataFrame:
    """Closed form over many days: ``stg_all`` is staging of every day. Equal
    to replaying :func:`scd2_merge` day by day (tested). Rows with a NULL key or
    attribute take no part, as in :func:`staging.variants`."""
    v = (stg_all.na.drop(subset=[*spec.columns, "create_dt"])
         .withColumn(DAY, F.to_date("create_dt"))
         .groupBy(*spec.columns, DAY)
         .agg(F.min("create_dt").alias("start_dt")))
    return version_chain(v.select(*spec.columns, "start_dt", F.lit(1).alias(SRC)), spec).select(
        *spec.columns, "start_dt", "end_dt")


def hist_as_of(hist: DataFrame, d: date | str) -> DataFrame:
    """History as it stood right after day ``d``'s load."""
    hi = day_end(d)
    return hist.where(F.col("start_dt") < hi).withColumn(
        "end_dt", F.when(F.col("end_dt") < hi, F.col("end_dt")))


def with_day_validity(hist: DataFrame) -> DataFrame:
    """Add ``valid_from_day`` / ``valid_to_day`` (exclusive, NULL = open): the
    version is the one in force at the end of day *x* iff
    ``valid_from_day <= x < valid_to_day``."""
    return (hist.withColumn("valid_from_day", F.to_date("start_dt"))
            .withColumn("valid_to_day", F.to_date("end_dt")))


def scd2_merge_literal(hist: DataFrame, day_variants: DataFrame, spec: DimSpec,
                       not_in_column: str | None = None) -> DataFrame:
    """The reference's three SCD2 statements taken literally: (a) close the
    open row when a variant differs, (b) open a version for each variant
    whose closed row ended at its time, (c) insert variants whose
    ``not_in_column`` value is NOT IN the stored keys. With
    ``not_in_column='account_num'`` for cards this reproduces the quirk that
    re-inserts every card daily."""
    k, attrs = spec.key, spec.attrs
    cols = [*spec.columns, "start_dt", "end_dt"]
    h = hist.select(*cols)
    v = day_variants.select(*spec.columns, "create_dt")
    # (a) UPDATE ... SET end_dt = stg.create_dt (earliest differing variant)
    opened = h.where(F.col("end_dt").isNull())
    hv = opened.alias("h").join(v.alias("v"), F.col(f"h.{k}") == F.col(f"v.{k}"))
    closes = (hv.where(changed([F.col(f"h.{a}") for a in attrs], [F.col(f"v.{a}") for a in attrs]))
              .groupBy(*[F.col(f"h.{c}").alias(c) for c in (*spec.columns, "start_dt")])
              .agg(F.min(F.col("v.create_dt")).alias("_close")))
    match = [F.col(f"o.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*spec.columns, "start_dt")]
    cond = match[0]
    for m in match[1:]:
        cond = cond & m
    after_a = (h.alias("o").join(closes.alias("c"), cond, "left")
               .select(*[F.col(f"o.{c}").alias(c) for c in spec.columns], F.col("o.start_dt").alias("start_dt"),
                       F.coalesce(F.col("o.end_dt"), F.col("c._close")).alias("end_dt")))
    # (b) INSERT stg x dim WHERE dim.end_dt = stg.create_dt AND attrs differ
    b = (v.alias("v").join(after_a.alias("d"), (F.col(f"v.{k}") == F.col(f"d.{k}"))
                           & (F.col("d.end_dt") == F.col("v.create_dt")))
         .where(changed([F.col(f"d.{a}") for a in attrs], [F.col(f"v.{a}") for a in attrs]))
         .select(*[F.col(f"v.{c}").alias(c) for c in spec.columns], F.col("v.create_dt").alias("start_dt"),
                 F.lit(None).cast("timestamp_ntz").alias("end_dt")))
    after_b = after_a.unionByName(b)
    # (c) INSERT stg WHERE col NOT IN (SELECT key FROM dim WHERE key IS NOT NULL)
    probe = not_in_column or k
    stored_keys = after_b.where(F.col(k).isNotNull()).select(F.col(k).alias("_sk"))
    c = (v.where(F.col(probe).isNotNull())
         .join(stored_keys, F.col(probe) == F.col("_sk"), "left_anti")
         .select(*spec.columns, F.col("create_dt").alias("start_dt"),
                 F.lit(None).cast("timestamp_ntz").alias("end_dt")))
    return after_b.unionByName(c)


# ----------------------------------------------------------------- SCD type 1

def scd1_chain(dim: DataFrame, day_variants: DataFrame, spec: DimSpec) -> DataFrame:
    """Version chain of stored type 1 rows and new variants (one or many
    days), keeping what :func:`collapse_scd1` needs."""
    stored = dim.select(*spec.columns, F.coalesce("update_dt", "create_dt").alias("start_dt"),
                        F.lit(0).alias(SRC), "create_dt", "update_dt")
    new = day_variants.select(*spec.columns, F.col("create_dt").alias("start_dt"), F.lit(1).alias(SRC),
                              "create_dt", F.lit(None).cast("timestamp_ntz").alias("update_dt"))
    return version_chain(stored.unionByName(new), spec)


def collapse_scd1(chain: DataFrame, spec: DimSpec) -> DataFrame:
    """One type 1 row per key from its version chain: the last version's
    attributes, ``create_dt`` = first seen, ``update_dt`` = start of the last
    version if there is more than one (else the stored ``update_dt``)."""
    wk = Window.partitionBy(spec.key)
    last = (chain.withColumn("_n", F.count(F.lit(1)).over(wk))
            .withColumn("_first", F.min("create_dt").over(wk))
            .where(F.col("end_dt").isNull()))
    update_dt = F.when(F.col(SRC) == 0, F.col("update_dt")).when(F.col("_n") > 1, F.col("start_dt"))
    return last.select(*spec.columns, F.col("_first").alias("create_dt"), update_dt.alias("update_dt"))


def scd1_upsert(dim: DataFrame, day_variants: DataFrame, spec: DimSpec) -> DataFrame:
    """Dimension after one day's load (type 1): changed keys take the
    latest variant and ``update_dt`` = its first-seen time; unseen keys are
    inserted with ``create_dt`` and ``update_dt`` NULL; rows of keys without
    variants pass through (see :func:`split_touched`)."""
    touched, untouched = split_touched(dim, day_variants, spec.key)
    merged = collapse_scd1(scd1_chain(touched, day_variants, spec), spec)
    return untouched.select(*spec.columns, "create_dt", "update_dt").unionByName(merged)


def scd1_from_history(hist: DataFrame, spec: DimSpec) -> DataFrame:
    """Type 1 view of a type 2 history: current attributes, ``create_dt`` =
    first version start, ``update_dt`` = current version start if the key
    ever changed."""
    kept = hist.select(*spec.columns, "start_dt", "end_dt", F.lit(1).alias(SRC),
                       F.col("start_dt").alias("create_dt"),
                       F.lit(None).cast("timestamp_ntz").alias("update_dt"))
    return collapse_scd1(kept, spec)


def scd1_backfill(stg_all: DataFrame, spec: DimSpec) -> DataFrame:
    """Closed form of replaying :func:`scd1_upsert` over every day."""
    return scd1_from_history(scd2_backfill(stg_all, spec), spec)


def insert_missing(dim: DataFrame, day_variants: DataFrame, spec: DimSpec,
                   gate: str = "per_key") -> DataFrame:
    """Variants to insert as new keys.

    ``per_key``: variants whose key is absent (left anti join on the key).
    ``all_or_nothing``: the reference's uncorrelated ``NOT EXISTS`` — every
    variant is inserted only if *no* staged key is already stored, otherwise
    none is (an uncorrelated EXISTS subquery)."""
    if gate == "per_key":
        return day_variants.join(dim.select(spec.key), spec.key, "left_anti")
    if gate == "all_or_nothing":
        staged_keys = day_variants.select(spec.key)
        clash = dim.select(spec.key).join(staged_keys, spec.key, "left_semi")
        return day_variants.where(~clash.exists())
    raise ValueError(f"unknown gate {gate!r}")


def scd1_upsert_literal(dim: DataFrame, day_variants: DataFrame, spec: DimSpec) -> DataFrame:
    """Type 1 load with the reference's all-or-nothing insert gate: updates
    as in :func:`scd1_upsert`, but new keys only enter on a day when none
    of the day's keys is stored yet."""
    stored_keys = dim.select(spec.key)
    updates = day_variants.join(stored_keys, spec.key, "left_semi")
    inserts = insert_missing(dim, day_variants, spec, gate="all_or_nothing")
    return scd1_upsert(dim, updates.unionByName(inserts), spec)


def anti_null_aware(left: DataFrame, lcol: str, right: DataFrame, rcol: str) -> DataFrame:
    """``left WHERE lcol NOT IN (SELECT rcol FROM right WHERE rcol IS NOT NULL)``.

    NULL probes are dropped (they go to quarantine before this point), so a
    plain ``left_anti`` join is exact and shuffles by key instead of forcing
    SQL ``NOT IN``'s null-aware broadcast."""
    keys = right.where(F.col(rcol).isNotNull()).select(F.col(rcol).alias("_nk"))
    return left.where(F.col(lcol).isNotNull()).join(keys, F.col(lcol) == F.col("_nk"), "left_anti")

"""Registered queries: one per operator of the inventory, each over the
driver's tables (landing derived from them by ``fixture_landing``).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle of the same key (``oracle.py``).
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_DOMAINS, REFERENCE_DOMAINS, checkpoint_dir, day_end, day_start, ts_literal
from ..functions import on_day
from ..operators import (
    amount_sequence,
    audit_fact,
    audit_scd1,
    audit_scd2,
    busy_cards,
    city_sequence,
    current,
    domain_violations,
    duplicate_keys,
    enrich,
    fraud_report,
    insert_missing,
    null_violations,
    numeric_violations,
    orphans,
    rule_amount_probe,
    rule_city_hop,
    rule_expired_account,
    rule_expired_passport,
    scd1_backfill,
    scd1_upsert,
    scd2_backfill,
    scd2_merge,
    stage,
    variants,
    width_violations,
)
from ..operators.rules import day_report_dt
from ..operators.keys import FACT_KEY, blooms, key_rows, may_hold, repeated_in
from ..operators.quality import history_check
from ..operators.scd import anti_null_aware, scd1_upsert_literal, scd2_merge_literal, with_day_validity
from ..schemas import DIMS, LANDING, LANDING_WIDTHS, NOT_NULL
from ..sources.landing import read_landing, row_problems, write_batches
from ..sources import conform, drop_blank, fixture_landing, split_late
from ..sources.warehouse import days_in
from .quality_days import quality_by_day

REPORT_DAY = date(2024, 1, 15)
LAST_DAY = date(2024, 1, 30)
RUN_TS = "2024-01-16 00:00:00"


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_landing(spark, sf_dir)


def _before(landing: DataFrame, d: date) -> DataFrame:
    """Landing rows of the days before ``d`` (history for an incremental step)."""
    return landing.where(F.col("date") < day_start(d))


def scd2_state(landing: DataFrame, name: str, d: date) -> DataFrame:
    """History after day ``d``: closed form up to the day before, then the
    incremental merge of day ``d``."""
    spec = DIMS[name]
    hist = scd2_backfill(stage(_before(landing, d), None)[name], spec)
    return scd2_merge(hist, variants(stage(landing, d)[name], spec), spec)


def scd1_state(landing: DataFrame, name: str, d: date) -> DataFrame:
    spec = DIMS[name]
    dim = scd1_backfill(stage(_before(landing, d), None)[name], spec)
    return scd1_upsert(dim, variants(stage(landing, d)[name], spec), spec)


def scd1_dims(landing: DataFrame, d: date) -> dict[str, DataFrame]:
    return {n: scd1_state(landing, n, d) for n in DIMS}


def scd2_current_dims(landing: DataFrame, d: date) -> dict[str, DataFrame]:
    return {n: current(scd2_state(landing, n, d)) for n in DIMS}


def _fact(landing: DataFrame, d: date) -> DataFrame:
    return stage(landing, d)["transactions"]


def _run_ts():
    return ts_literal(RUN_TS)


# ------------------------------------------------------------------ landing

def q_landing_conform(spark, sf_dir):
    src = _landing(spark, sf_dir)
    # Columns arrive in another order and one is missing: selection is by
    # name and the missing column comes back all-NULL.
    shuffled = src.select(*reversed([c for c in src.columns if c != "address"]))
    return conform(shuffled, LANDING)


def q_landing_drop_blank(spark, sf_dir):
    src = _landing(spark, sf_dir)
    blanks = src.where(F.col("oper_result") == "refused").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in LANDING.fields])
    return drop_blank(src.unionByName(blanks))


def q_late_split(spark, sf_dir):
    _, off = split_late(_landing(spark, sf_dir), REPORT_DAY)
    return off.select("trans_id", "date", "reason")


# ------------------------------------------------------------------ staging

def _stage_query(name):
    def q(spark, sf_dir):
        return stage(_landing(spark, sf_dir), REPORT_DAY)[name]
    return q


def _variants_query(name):
    def q(spark, sf_dir):
        return variants(stage(_landing(spark, sf_dir), REPORT_DAY)[name], DIMS[name])
    return q


# ------------------------------------------------------------------ SCD

def _scd1_query(name):
    def q(spark, sf_dir):
        return scd1_state(_landing(spark, sf_dir), name, LAST_DAY)
    return q


def _scd2_query(name):
    def q(spark, sf_dir):
        return scd2_state(_landing(spark, sf_dir), name, LAST_DAY)
    return q


def q_scd1_insert_gate(spark, sf_dir):
    """Accounts inserted on the report day under both insert gates."""
    lnd = _landing(spark, sf_dir)
    spec = DIMS["accounts"]
    dim = scd1_backfill(stage(_before(lnd, REPORT_DAY), None)["accounts"], spec)
    v = variants(stage(lnd, REPORT_DAY)["accounts"], spec)
    per_key = insert_missing(dim, v, spec, "per_key").withColumn("gate", F.lit("per_key"))
    gated = insert_missing(dim, v, spec, "all_or_nothing").withColumn("gate", F.lit("all_or_nothing"))
    return per_key.unionByName(gated)


def q_scd2_insert_not_in(spark, sf_dir):
    """Account versions opened on the report day for keys NOT IN the
    history stored before it."""
    lnd = _landing(spark, sf_dir)
    spec = DIMS["accounts"]
    hist = scd2_backfill(stage(_before(lnd, REPORT_DAY), None)["accounts"], spec)
    v = variants(stage(lnd, REPORT_DAY)["accounts"], spec)
    return anti_null_aware(v, "account_num", hist, "account_num")


def q_scd1_literal_accounts(spark, sf_dir):
    """Accounts after the report day under the reference's all-or-nothing
    insert gate, starting from the per-key state of the day before."""
    lnd = _landing(spark, sf_dir)
    spec = DIMS["accounts"]
    dim = scd1_backfill(stage(_before(lnd, REPORT_DAY), None)["accounts"], spec)
    return scd1_upsert_literal(dim, variants(stage(lnd, REPORT_DAY)["accounts"], spec), spec)


def q_scd2_cards_literal(spark, sf_dir):
    """Card history after the reference's three SCD2 statements for the
    report day, taken literally (``account_num NOT IN (card_num …)``)."""
    lnd = _landing(spark, sf_dir)
    spec = DIMS["cards"]
    hist = scd2_backfill(stage(_before(lnd, REPORT_DAY), None)["cards"], spec)
    return scd2_merge_literal(hist, variants(stage(lnd, REPORT_DAY)["cards"], spec), spec, "account_num")


# ------------------------------------------------------------------ audit

def q_audit_scd1(spark, sf_dir):
    lnd = _landing(spark, sf_dir)
    parts = [audit_scd1(scd1_state(lnd, n, REPORT_DAY), n, REPORT_DAY, RUN_TS) for n in DIMS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_audit_scd2(spark, sf_dir):
    lnd = _landing(spark, sf_dir)
    parts = [audit_scd2(scd2_state(lnd, n, REPORT_DAY), n, REPORT_DAY, RUN_TS) for n in DIMS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_audit_fact(spark, sf_dir):
    return audit_fact(_fact(_landing(spark, sf_dir), REPORT_DAY), REPORT_DAY, RUN_TS)


# ------------------------------------------------------------------ fact

def q_fact_load(spark, sf_dir):
    f = _fact(_landing(spark, sf_dir), REPORT_DAY)
    return f.withColumn("trans_dt", F.to_date("trans_date"))


def q_fact_by_partition(spark, sf_dir):
    f = stage(_landing(spark, sf_dir), None)["transactions"]
    return (f.groupBy(F.col("load_dt").alias("trans_dt"), "oper_type", "oper_result")
            .agg(F.count(F.lit(1)).alias("n_rows")))


# ------------------------------------------------------------------ report pieces

def q_busy_cards(spark, sf_dir):
    return busy_cards(_fact(_landing(spark, sf_dir), REPORT_DAY), 1)


_ENRICHED = ["trans_id", "trans_date", "card_num", "passport_num", "fio", "phone",
             "passport_valid_to", "account_valid_to"]


def q_tx_enriched(spark, sf_dir):
    lnd = _landing(spark, sf_dir)
    return enrich(_fact(lnd, REPORT_DAY), scd1_dims(lnd, REPORT_DAY)).select(*_ENRICHED)


def q_tx_enriched_current(spark, sf_dir):
    lnd = _landing(spark, sf_dir)
    return enrich(_fact(lnd, REPORT_DAY), scd2_current_dims(lnd, REPORT_DAY)).select(*_ENRICHED)


def q_city_sequence(spark, sf_dir):
    lnd = _landing(spark, sf_dir)
    s = city_sequence(_fact(lnd, REPORT_DAY), scd1_state(lnd, "terminals", REPORT_DAY))
    return s.select("card_num", "trans_id", "trans_date", "cur_city", "prev_trans_date", "prev_city")


def q_amount_sequence(spark, sf_dir):
    return amount_sequence(_fact(_landing(spark, sf_dir), REPORT_DAY), FIXTURE_DOMAINS)


def _rule_query(fn, **kw):
    def q(spark, sf_dir):
        lnd = _landing(spark, sf_dir)
        return fn(_fact(lnd, REPORT_DAY), scd1_dims(lnd, REPORT_DAY), _run_ts(), **kw)
    return q


def q_report_day_scd1(spark, sf_dir):
    lnd = _landing(spark, sf_dir)
    return fraud_report(_fact(lnd, REPORT_DAY), scd1_dims(lnd, REPORT_DAY), _run_ts(), FIXTURE_DOMAINS)


def q_report_day_scd2(spark, sf_dir):
    lnd = _landing(spark, sf_dir)
    return fraud_report(_fact(lnd, REPORT_DAY), scd2_current_dims(lnd, REPORT_DAY), _run_ts(), FIXTURE_DOMAINS)


def versioned_dims(landing: DataFrame) -> dict[str, DataFrame]:
    """Every dimension's full history with day validity (closed form)."""
    st = stage(landing, None)
    return {n: with_day_validity(scd2_backfill(st[n], spec)) for n, spec in DIMS.items()}


def q_report_all_days(spark, sf_dir):
    """Every day's report at once: each operation meets the dimension
    versions in force at the end of its own day."""
    lnd = _landing(spark, sf_dir)
    fact = stage(lnd, None)["transactions"].drop("load_dt")
    return fraud_report(fact, versioned_dims(lnd), day_report_dt(), FIXTURE_DOMAINS)


# ------------------------------------------------------------------ rejects and NULLs

def _dirty(landing: DataFrame) -> DataFrame:
    """Landing rows with faults spread by trans_id: NULLs, values outside the
    domains and over-long text among clean ones."""
    i = F.col("trans_id").cast("bigint")
    faults = {
        "passport": F.when(i % 7 == 3, F.lit(None)).otherwise(F.col("passport")),
        "phone": F.when(i % 11 == 5, F.lit(None)).otherwise(F.col("phone")),
        "client": F.when(i % 83 == 7, F.lit(None)).otherwise(F.col("client")),
        "oper_type": F.when(i % 13 == 1, F.lit("gift")).otherwise(F.col("oper_type")),
        "oper_result": F.when(i % 17 == 2, F.lit(None)).otherwise(F.col("oper_result")),
        "last_name": F.when(i % 19 == 4, F.repeat(F.lit("x"), 60)).otherwise(F.col("last_name")),
    }
    return landing.withColumns(faults)


def q_landing_rejects(spark, sf_dir):
    """Text cells that do not parse and NULLs that the tables refuse: every
    such row with each of its reasons."""
    i = F.col("trans_id").cast("bigint")
    raw = _landing(spark, sf_dir)
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).withColumns({
        "date": F.when(i % 97 == 3, F.lit("no day")).otherwise(F.col("date")),
        "amount": F.when(i % 89 == 5, F.lit("much")).otherwise(F.col("amount")),
        "client": F.when(i % 83 == 7, F.lit(None)).otherwise(F.col("client"))})
    rows = row_problems(conform(raw, LANDING, bad_cells=True))
    return rows.select("trans_id", F.explode("problems").alias("reason"))


def q_scd1_clients_nulls(spark, sf_dir):
    """Clients (type 1) from rows some of which hold NULLs: those are kept out."""
    return scd1_state(_dirty(_landing(spark, sf_dir)), "clients", LAST_DAY)


def q_scd2_clients_nulls(spark, sf_dir):
    return scd2_state(_dirty(_landing(spark, sf_dir)), "clients", LAST_DAY)


def q_rule_amount_probe_ref(spark, sf_dir):
    """Rule 4 with the default (reference) domains, on the fixture's results mapped to them."""
    lnd = _landing(spark, sf_dir)
    result = F.when(F.col("oper_result") == FIXTURE_DOMAINS.success, REFERENCE_DOMAINS.success) \
        .otherwise(REFERENCE_DOMAINS.refused)
    fact = _fact(lnd, REPORT_DAY).withColumn("oper_result", result)
    return rule_amount_probe(fact, scd1_dims(lnd, REPORT_DAY), _run_ts())


# ------------------------------------------------------------------ keys and landing

def _again(landing: DataFrame) -> DataFrame:
    """Every operation, every fifth a second time an hour later and every seventh a third time
    a day later; ``copy`` tells them apart."""
    i = F.col("trans_id").cast("bigint")
    copies = F.filter(F.array(F.lit(0), F.when(i % 5 == 0, F.lit(1)), F.when(i % 7 == 3, F.lit(2))), lambda x: x.isNotNull())
    shift = F.when(F.col("copy") == 1, F.expr("INTERVAL '1' HOUR")).when(F.col("copy") == 2, F.expr("INTERVAL '24' HOUR")) \
        .otherwise(F.expr("INTERVAL '0' HOUR"))
    return landing.withColumn("copy", F.explode(copies)).withColumn("date", F.col("date") + shift)


def q_fact_duplicates(spark, sf_dir):
    """Operations of the report day that the fact's primary key refuses: their key has an earlier row in the
    batch, or (found through the days' key indexes) in any day before."""
    rows = _again(_landing(spark, sf_dir)).select("trans_id", "oper_type", "oper_result", "date", "copy")
    batch = rows.where(on_day("date", REPORT_DAY))
    index = key_rows(rows.where(F.col("date") < day_start(REPORT_DAY)).withColumn("load_dt", F.to_date("date")), "load_dt")
    sizes = [1 << k for k in range(33)]  # whatever a day's size is
    hits = may_hold(key_rows(batch), blooms(index), sizes)
    known = hits.join(index, ["load_dt", "h", *FACT_KEY], "left_semi").select(*FACT_KEY).distinct()
    refused = repeated_in(batch, ["date", "copy"]).union(batch.join(known, list(FACT_KEY), "left_semi").select(*batch.columns))
    return refused.distinct()


def q_fact_unique(spark, sf_dir):
    """Facts kept per day when every day's rows come with repeated keys: the first row of each key stays."""
    rows = _again(_landing(spark, sf_dir)).where(F.col("date") < day_end(LAST_DAY)).select(*FACT_KEY, "date", "copy")
    kept = rows.join(repeated_in(rows, ["date", "copy"]), [*FACT_KEY, "date", "copy"], "left_anti")
    return kept.groupBy(F.to_date("date").alias("trans_dt")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("copy") > 0).alias("n_late"))


def q_landing_written(spark, sf_dir):
    """The landing after all its writers: batches landed by file, parts of a stream's epoch (landed twice, as after
    a failure), and corrected batches of every third day. Rows per day and part, as read back."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    rows = _landing(spark, sf_dir).withColumn("batch_dt", F.to_date("date"))
    rows = conform(rows, LANDING, keep=("batch_dt",), bad_cells=True)
    days = [d for d in days_in(date(2024, 1, 1), LAST_DAY)]
    i = F.col("trans_id").cast("bigint")
    write_batches(rows.where(i % 4 != 1), root, days)
    for _ in range(2):
        write_batches(rows.where(i % 4 == 1), root, days, "epoch-0")
    corrected = [d for d in days if d.day % 3 == 0]
    write_batches(rows.where((i % 4 != 1) & (i % 8 != 2) & (F.dayofmonth("batch_dt") % 3 == 0)), root, corrected)
    return read_landing(spark, root).groupBy("batch_dt").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(i).alias("ids"), F.count_if(F.col("bad_cells").isNotNull()).alias("n_bad"))


# ------------------------------------------------------------------ data quality

def _third(key: str):
    """About a third of the keys: by the code of the last character."""
    return F.ascii(F.substring(key, -1, 1)) % 3 == 0


def _every_third_twice(df: DataFrame, key: str) -> DataFrame:
    return df.unionByName(df.where(_third(key)))


def q_dq_duplicate_keys(spark, sf_dir):
    """Primary keys of the dimensions (type 1 state) and histories (key, start_dt),
    with every third key stored twice: the duplicated keys per table."""
    staged = stage(_landing(spark, sf_dir), None)
    parts = []
    for n, spec in DIMS.items():
        hist = scd2_backfill(staged[n], spec)
        for table, df, keys in ((f"dim_{n}", current(hist), [spec.key]),
                                (f"dim_{n}_hist", hist, [spec.key, "start_dt"])):
            dup = duplicate_keys(_every_third_twice(df, spec.key), keys)
            parts.append(dup.agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n_keys"),
                                 F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dq_orphans(spark, sf_dir):
    """The four foreign keys over all days, against parents as of the report day's
    eve: rows whose parent came later or never."""
    lnd = _landing(spark, sf_dir)
    old = stage(_before(lnd, REPORT_DAY), None)
    parents = {n: scd1_backfill(old[n], spec) for n, spec in DIMS.items()}
    now = stage(lnd, None)
    children = {n: scd1_backfill(now[n], spec) for n, spec in DIMS.items()}
    keys = (("accounts", children["accounts"], "client", "clients"),
            ("cards", children["cards"], "account_num", "accounts"), ("fact", now["transactions"], "card_num", "cards"), ("fact", now["transactions"], "terminal", "terminals"))
    return _union([orphans(df, fk, parents[parent], DIMS[parent].key)
                   .agg(F.lit(child).alias("child"), F.lit(parent).alias("parent"), F.count(F.lit(1)).alias("n_rows"))
                   for child, df, fk, parent in keys])


def q_dq_nulls(spark, sf_dir):
    """NOT NULL columns of the dimensions' and the fact's feeds, with NULLs among the rows."""
    st = stage(_dirty(_landing(spark, sf_dir)), None)
    return _union([null_violations(st[n], list(cols)).withColumn("table_name", F.lit(n))
                   for n, cols in NOT_NULL.items() if n in st])


def q_dq_domain(spark, sf_dir):
    """Operation types and results outside the list domains."""
    f = stage(_dirty(_landing(spark, sf_dir)), None)["transactions"]
    return _union([domain_violations(f, c, allowed).groupBy(F.lit(c).alias("column_name"), F.col(c).alias("value"))
                   .agg(F.count(F.lit(1)).alias("n_rows"))
                   for c, allowed in (("oper_type", FIXTURE_DOMAINS.oper_types),
                                      ("oper_result", FIXTURE_DOMAINS.oper_results))])


def q_dq_width(spark, sf_dir):
    return width_violations(_dirty(_landing(spark, sf_dir)), LANDING_WIDTHS)


def q_dq_numeric(spark, sf_dir):
    """Amounts, some of them a billion times as large, that do not fit numeric(10,2)."""
    i = F.col("trans_id").cast("bigint")
    big = _landing(spark, sf_dir).select("trans_id", F.when(i % 23 == 6, F.col("amount").cast("decimal(28,2)") * 1000000000)
                                         .otherwise(F.col("amount")).cast("decimal(28,2)").alias("amount"))
    return numeric_violations(big, "amount").select("trans_id")


def q_dq_history(spark, sf_dir):
    """History invariants of every SCD2 dimension after the last day, with the
    closed versions of every third key ending a day late: versions, open
    versions and violations per table."""
    lnd = _landing(spark, sf_dir)
    parts = []
    for n, spec in DIMS.items():
        hist = scd2_state(lnd, n, LAST_DAY).withColumn("end_dt", F.when(
            _third(spec.key), F.col("end_dt") + F.expr("INTERVAL '1' DAY")).otherwise(F.col("end_dt")))
        h = history_check(hist, spec.key)
        parts.append(h.agg(F.lit(n).alias("table_name"),
                           F.count(F.lit(1)).alias("n_versions"),
                           F.count_if(F.col("end_dt").isNull()).alias("n_open"),
                           F.count_if(F.col("problem").isNotNull()).alias("n_violations")))
    return _union(parts)


def q_dq_by_day(spark, sf_dir):
    """Quality counts of every day from 2024-01-05 on in one pass, with faulty rows among the operations and
    the closed versions of every third key ending a day late (so two of them are in force on that day)."""
    staged = stage(_dirty(_landing(spark, sf_dir)).where(F.col("date") < day_end(LAST_DAY)), None)
    versions = {}
    for n, spec in DIMS.items():
        hist = scd2_backfill(staged[n], spec).withColumn("end_dt", F.when(
            _third(spec.key), F.col("end_dt") + F.expr("INTERVAL '1' DAY")).otherwise(F.col("end_dt")))
        versions[n] = with_day_validity(hist)
    start = date(2024, 1, 5)
    fact = staged["transactions"].withColumn("trans_dt", F.to_date("trans_date")).where(F.col("trans_dt") >= F.lit(start))
    return quality_by_day(versions, fact, start, LAST_DAY, FIXTURE_DOMAINS)


def build() -> dict:
    q: dict = {
        "landing_conform": q_landing_conform,
        "landing_drop_blank": q_landing_drop_blank,
        "late_split": q_late_split,
    }
    for n in ("clients", "accounts", "cards", "terminals", "transactions"):
        q[f"stage_{n}"] = _stage_query(n)
    for n in DIMS:
        q[f"variants_{n}"] = _variants_query(n)
    for n in DIMS:
        q[f"scd1_{n}"] = _scd1_query(n)
    q["scd1_insert_gate"] = q_scd1_insert_gate
    for n in DIMS:
        q[f"scd2_{n}"] = _scd2_query(n)
    q.update({
        "scd1_literal_accounts": q_scd1_literal_accounts,
        "scd2_cards_literal": q_scd2_cards_literal,
        "scd2_insert_not_in": q_scd2_insert_not_in,
        "audit_scd1": q_audit_scd1,
        "audit_scd2": q_audit_scd2,
        "audit_fact": q_audit_fact,
        "fact_load": q_fact_load,
        "fact_by_partition": q_fact_by_partition,
        "busy_cards": q_busy_cards,
        "tx_enriched": q_tx_enriched,
        "tx_enriched_current": q_tx_enriched_current,
        "city_sequence": q_city_sequence,
        "amount_sequence": q_amount_sequence,
        "rule_expired_passport": _rule_query(rule_expired_passport),
        "rule_expired_account": _rule_query(rule_expired_account),
        "rule_city_hop": _rule_query(rule_city_hop),
        "rule_amount_probe": _rule_query(rule_amount_probe, domains=FIXTURE_DOMAINS),
        "rule_amount_probe_ref": q_rule_amount_probe_ref,
        "landing_rejects": q_landing_rejects,
        "scd1_clients_nulls": q_scd1_clients_nulls,
        "scd2_clients_nulls": q_scd2_clients_nulls,
        "report_day_scd1": q_report_day_scd1,
        "report_day_scd2": q_report_day_scd2,
        "report_all_days": q_report_all_days,
        "fact_duplicates": q_fact_duplicates,
        "fact_unique": q_fact_unique,
        "landing_written": q_landing_written,
        "dq_duplicate_keys": q_dq_duplicate_keys,
        "dq_orphans": q_dq_orphans,
        "dq_nulls": q_dq_nulls,
        "dq_domain": q_dq_domain,
        "dq_width": q_dq_width,
        "dq_numeric": q_dq_numeric,
        "dq_history": q_dq_history,
        "dq_by_day": q_dq_by_day,
    })
    return q

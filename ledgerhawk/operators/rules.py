"""The four fraud rules and the joins they share.

Every rule works on fact rows tagged with their ``day``. Dimensions are
either snapshots (one row per key: an SCD1 table or the open SCD2 rows) or
histories with ``valid_from_day``/``valid_to_day`` (see
``scd.with_day_validity``), in which case each join takes the version in
force at the end of the row's day (:func:`versions_in_force`). The same code therefore serves one day
and a whole backfill of days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    AMOUNT_PROBE_MIN_OPS_EXCLUSIVE,
    CITY_HOP_MAX_GAP_SECONDS,
    FRAUD_AMOUNT_PROBE,
    FRAUD_CITY_HOP,
    FRAUD_EXPIRED_ACCOUNT,
    FRAUD_EXPIRED_PASSPORT,
    REFERENCE_DOMAINS,
    Domains,
)
from ..functions import falling_flag, full_name, result_code, within
from .sequence import HOT_ROWS, exact_lag

DAY = "day"
ORDER = ["trans_date", "trans_id"]  # ties in time are broken by trans_id


def with_day(fact: DataFrame) -> DataFrame:
    """Fact rows with their ``day``; rows without a card or time cannot be
    reported (every rule ends in an inner join on the card)."""
    return (fact.where(F.col("card_num").isNotNull() & F.col("trans_date").isNotNull())
            .withColumn(DAY, F.to_date("trans_date")))


def _is_history(dim: DataFrame) -> bool:
    return "valid_from_day" in dim.columns


def versions_in_force(pairs: DataFrame, versions: DataFrame, key: str, take: list[str]) -> DataFrame:
    """``pairs (key, day)`` with the columns ``take`` of the version in force at the end of the
    day, as ``_d_<column>``; pairs without one drop.

    An as-of join in one ordered pass per key: versions (at the day they start) and
    pairs are merged, and the last version before a pair is its own unless it has ended.
    A key costs its days plus its versions, never their product."""
    version = F.struct(*[F.col(c) for c in take], "valid_to_day")
    starts = versions.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col("valid_from_day").alias("_at"), F.lit(0).alias("_probe"),
        F.col("start_dt").alias("_since"), version.alias("_v"))
    probes = pairs.select(F.col("_k"), F.col(DAY).alias("_at"), F.lit(1).alias("_probe"),
                          F.lit(None).cast("timestamp_ntz").alias("_since"), F.lit(None).cast(starts.schema["_v"].dataType).alias("_v"))
    before = Window.partitionBy("_k").orderBy("_at", "_probe", "_since").rowsBetween(Window.unboundedPreceding, 0)
    found = starts.unionByName(probes).withColumn("_v", F.last("_v", ignorenulls=True).over(before)).where("_probe = 1")
    ended = F.col("_v.valid_to_day") <= F.col("_at")
    return found.where(F.col("_v").isNotNull() & ~F.coalesce(ended, F.lit(False))).select(
        "_k", F.col("_at").alias(DAY), *[F.col(f"_v.{c}").alias(f"_d_{c}") for c in take])


def _join_dim(left: DataFrame, dim: DataFrame, left_key: str, dim_key: str, take: list[str]) -> DataFrame:
    """Inner join on the key; for histories, with the version of the row's day. That is found once
    for each distinct (key, day) and then joined by equality, so rows never multiply by versions."""
    if not _is_history(dim):
        d = dim.select(F.col(dim_key).alias("_k"), *[F.col(c).alias(f"_d_{c}") for c in take])
        joined = left.join(d, left[left_key] == d["_k"])
    else:
        pairs = left.where(F.col(left_key).isNotNull()).select(F.col(left_key).alias("_k"), DAY).distinct()
        d = versions_in_force(pairs, dim, dim_key, take).withColumnRenamed(DAY, "_day")
        joined = left.join(d, (left[left_key] == d["_k"]) & (left[DAY] == d["_day"]))
    return joined.select(*[left[c] for c in left.columns], *[F.col(f"_d_{c}").alias(c) for c in take])


def card_profile(card_days: DataFrame, cards: DataFrame, accounts: DataFrame,
                 clients: DataFrame) -> DataFrame:
    """Owner details for each (card, day): card -> account -> client.

    The three dimension joins run on the distinct (card, day) pairs, not on
    the fact, so the fact itself is joined once (to this profile)."""
    p = _join_dim(card_days, cards, "card_num", "card_num", ["account_num"])
    p = _join_dim(p, accounts, "account_num", "account_num", ["valid_to", "client"])
    p = _join_dim(p, clients, "client", "client_id",
                  ["passport_num", "passport_valid_to", "last_name", "first_name", "patronymic", "phone"])
    return p.select(
        "card_num", DAY, "passport_num", "passport_valid_to",
        F.col("valid_to").alias("account_valid_to"),
        full_name("last_name", "first_name", "patronymic").alias("fio"), "phone")


def profile_for(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    card_days = fact.select("card_num", DAY).distinct()
    return card_profile(card_days, dims["cards"], dims["accounts"], dims["clients"])


def busy_cards(fact: DataFrame, min_exclusive: int) -> DataFrame:
    """Cards with more than ``min_exclusive`` operations in a day
    (``GROUP BY card HAVING COUNT(*) > n``; partial aggregation first)."""
    return (with_day(fact).groupBy("card_num", DAY).agg(F.count(F.lit(1)).alias("n_trans"))
            .where(F.col("n_trans") > min_exclusive))


def enrich(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows joined to their owner profile (inner: rows whose card,
    account or client is unknown drop, as in the reference)."""
    f = with_day(fact)
    return f.join(profile_for(f, dims), ["card_num", DAY])


def report_rows(df: DataFrame, fraud_dt: str, fraud_type: Column, report_dt: Column,
                keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(F.col(fraud_dt).alias("fraud_dt"), F.col("passport_num").alias("passport"),
                     "fio", "phone", fraud_type.alias("fraud_type"), report_dt.alias("report_dt"), *keep)


def expiry_flags(enriched: DataFrame) -> DataFrame:
    """Rules 1 and 2 in one pass over the enriched rows: each row yields
    0, 1 or 2 fraud types (strict ``<`` on timestamps)."""
    flags = F.array(
        F.when(F.col("passport_valid_to") < F.col("trans_date"), F.lit(FRAUD_EXPIRED_PASSPORT)),
        F.when(F.col("account_valid_to") < F.col("trans_date"), F.lit(FRAUD_EXPIRED_ACCOUNT)),
    )
    return enriched.withColumn("fraud_type", F.explode(F.filter(flags, lambda x: x.isNotNull())))


def rule_expired_passport(fact, dims, report_dt: Column) -> DataFrame:
    e = enrich(fact, dims).where(F.col("passport_valid_to") < F.col("trans_date"))
    return report_rows(e, "trans_date", F.lit(FRAUD_EXPIRED_PASSPORT), report_dt)


def rule_expired_account(fact, dims, report_dt: Column) -> DataFrame:
    e = enrich(fact, dims).where(F.col("account_valid_to") < F.col("trans_date"))
    return report_rows(e, "trans_date", F.lit(FRAUD_EXPIRED_ACCOUNT), report_dt)


def with_owner(hits: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Few rows (rule hits) joined straight to card, account and client."""
    p = _join_dim(hits, dims["cards"], "card_num", "card_num", ["account_num"])
    p = _join_dim(p, dims["accounts"], "account_num", "account_num", ["client"])
    p = _join_dim(p, dims["clients"], "client", "client_id",
                  ["passport_num", "last_name", "first_name", "patronymic", "phone"])
    return p.select(*hits.columns, "passport_num", full_name("last_name", "first_name", "patronymic").alias("fio"),
                    "phone")


def city_sequence(fact: DataFrame, terminals: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per card and day, each operation at a known terminal with the time and
    city of the card's previous such operation (the terminal join comes before
    LAG, so unknown terminals leave the sequence). One exchange on (card, day)."""
    f = with_day(fact).select("trans_id", "trans_date", "card_num", "terminal", DAY)
    t = _join_dim(f, terminals, "terminal", "terminal_id", ["terminal_city"]).drop("terminal")
    t = t.withColumnRenamed("terminal_city", "city")
    s = exact_lag(t, ["card_num", DAY], ORDER, ["trans_date", "city"], hot_rows=hot_rows, sizes=f)
    return s.select("trans_id", "trans_date", "card_num", DAY, F.col("city").alias("cur_city"),
                    "prev_trans_date", "prev_city")


def city_hops(fact: DataFrame, terminals: DataFrame, max_gap_seconds: int = CITY_HOP_MAX_GAP_SECONDS,
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """(card, day, trans_date) of operations within ``max_gap_seconds``
    (inclusive) of the card's previous one, in another city."""
    s = city_sequence(fact, terminals, hot_rows)
    hop = within(F.col("trans_date") - F.col("prev_trans_date"), max_gap_seconds) & (
        F.col("prev_city") != F.col("cur_city"))
    return s.where(hop).select("card_num", DAY, "trans_date")


def rule_city_hop(fact, dims, report_dt: Column, max_gap_seconds: int = CITY_HOP_MAX_GAP_SECONDS,
                  hot_rows: int = HOT_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    e = with_owner(city_hops(fact, dims["terminals"], max_gap_seconds, hot_rows), dims)
    return report_rows(e, "trans_date", F.lit(FRAUD_CITY_HOP), report_dt, keep)


def amount_sequence(fact: DataFrame, domains: Domains = REFERENCE_DOMAINS,
                    min_ops_exclusive: int = AMOUNT_PROBE_MIN_OPS_EXCLUSIVE,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per busy card and day: number of operations, time of the last one,
    number of successes, number of non-falling steps and the last result.

    The reference's four whole-partition windows collapse into one group-by on
    the LAG's own exchange. No terminal is read."""
    f = with_day(fact).select("trans_id", "trans_date", "card_num", "amt", "oper_result", DAY)
    s = exact_lag(f, ["card_num", DAY], ORDER, ["amt"], hot_rows=hot_rows)
    last = F.struct(*[F.col(c) for c in ORDER])
    return (s.groupBy("card_num", DAY).agg(
        F.count(F.lit(1)).alias("n_trans"),
        F.max("trans_date").alias("last_trans_date"),
        F.sum(result_code("oper_result", domains.success, domains.refused)).alias("oper_result_total"),
        F.sum(falling_flag("amt", F.col("prev_amt"))).alias("prev_less_than_cur_total"),
        F.max_by("oper_result", last).alias("last_oper"))
        .where(F.col("n_trans") > min_ops_exclusive))


def amount_probes(fact: DataFrame, domains: Domains = REFERENCE_DOMAINS,
                  min_ops_exclusive: int = AMOUNT_PROBE_MIN_OPS_EXCLUSIVE,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Busy cards whose amounts strictly fell, with exactly one success and
    that success last; fraud time = the last operation."""
    a = amount_sequence(fact, domains, min_ops_exclusive, hot_rows)
    hit = ((F.col("oper_result_total") == 1) & (F.col("last_oper") == domains.success)
           & (F.col("prev_less_than_cur_total") == 0))
    return a.where(hit).select("card_num", DAY, F.col("last_trans_date").alias("trans_date"))


def rule_amount_probe(fact, dims, report_dt: Column, domains: Domains = REFERENCE_DOMAINS,
                      min_ops_exclusive: int = AMOUNT_PROBE_MIN_OPS_EXCLUSIVE,
                      hot_rows: int = HOT_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    e = with_owner(amount_probes(fact, domains, min_ops_exclusive, hot_rows), dims)
    return report_rows(e, "trans_date", F.lit(FRAUD_AMOUNT_PROBE), report_dt, keep)


def fraud_report(fact: DataFrame, dims: dict[str, DataFrame], report_dt: Column,
                 domains: Domains = REFERENCE_DOMAINS, hot_rows: int = HOT_ROWS,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """All four rules, appended (bag semantics). Rules 1 and 2 share one
    enriched pass; rules 3 and 4 join their few hits to the owners. Columns
    named in ``keep`` (``day``) go along."""
    e = expiry_flags(enrich(fact, dims))
    r12 = report_rows(e, "trans_date", F.col("fraud_type"), report_dt, keep)
    r3 = rule_city_hop(fact, dims, report_dt, hot_rows=hot_rows, keep=keep)
    r4 = rule_amount_probe(fact, dims, report_dt, domains, hot_rows=hot_rows, keep=keep)
    return r12.unionByName(r3).unionByName(r4)


def day_report_dt() -> Column:
    """Per-day run time for backfills: the end of each row's day."""
    return F.date_add(F.col(DAY), 1).cast("timestamp_ntz")

"""SCD1 / SCD2 semantics on small inline inputs and on the fixtures."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF0001
from ledgerhawk.operators import (
    current,
    history_violations,
    insert_missing,
    scd1_backfill,
    scd1_upsert,
    scd2_backfill,
    scd2_merge,
    stage,
    variants,
)
from ledgerhawk.operators.scd import scd1_from_history, scd1_upsert_literal, scd2_merge_literal
from ledgerhawk.schemas import CARDS, DIMS
from ledgerhawk.sources import fixture_landing

STG = "card_num string, account_num string, create_dt timestamp_ntz"
H2 = "card_num string, account_num string, start_dt timestamp_ntz, end_dt timestamp_ntz"
H1 = "card_num string, account_num string, create_dt timestamp_ntz, update_dt timestamp_ntz"


def t(s):
    return datetime.fromisoformat(s)


def stg(spark, rows):
    return spark.createDataFrame([(k, a, t(ts)) for k, a, ts in rows], STG)


def day_vars(spark, rows):
    return variants(stg(spark, rows), CARDS)


def rows_of(df, *cols):
    return sorted(tuple(None if r[c] is None else str(r[c]) for c in cols) for r in df.collect())


def test_variants_first_seen_and_null_key(spark):
    v = day_vars(spark, [("C1", "A", "2024-01-01 10:00:00"), ("C1", "A", "2024-01-01 09:00:00"),
                         ("C1", "B", "2024-01-01 11:00:00"), (None, "A", "2024-01-01 12:00:00")])
    assert rows_of(v, "card_num", "account_num", "create_dt") == [
        ("C1", "A", "2024-01-01 09:00:00"), ("C1", "B", "2024-01-01 11:00:00")]


def test_scd2_change_closes_and_opens(spark):
    hist = spark.createDataFrame([("C1", "A", t("2024-01-01 09:00:00"), None),
                                  ("C2", "X", t("2024-01-01 09:00:00"), None)], H2)
    v = day_vars(spark, [("C1", "B", "2024-01-02 10:00:00"), ("C2", "X", "2024-01-02 11:00:00"),
                         ("C3", "Z", "2024-01-02 12:00:00")])
    out = scd2_merge(hist, v, CARDS)
    assert rows_of(out, "card_num", "account_num", "start_dt", "end_dt") == [
        ("C1", "A", "2024-01-01 09:00:00", "2024-01-02 10:00:00"),
        ("C1", "B", "2024-01-02 10:00:00", None),
        ("C2", "X", "2024-01-01 09:00:00", None),
        ("C3", "Z", "2024-01-02 12:00:00", None)]
    assert history_violations(out, "card_num").count() == 0


def test_scd2_two_variants_in_a_day_are_chained(spark):
    hist = spark.createDataFrame([("C1", "A", t("2024-01-01 09:00:00"), None)], H2)
    v = day_vars(spark, [("C1", "B", "2024-01-02 10:00:00"), ("C1", "C", "2024-01-02 11:00:00")])
    out = scd2_merge(hist, v, CARDS)
    assert rows_of(out, "account_num", "start_dt", "end_dt") == [
        ("A", "2024-01-01 09:00:00", "2024-01-02 10:00:00"),
        ("B", "2024-01-02 10:00:00", "2024-01-02 11:00:00"),
        ("C", "2024-01-02 11:00:00", None)]


def test_scd2_a_b_a_makes_three_versions(spark):
    s = stg(spark, [("C1", "A", "2024-01-01 09:00:00"), ("C1", "B", "2024-01-02 09:00:00"),
                    ("C1", "A", "2024-01-03 09:00:00"), ("C1", "A", "2024-01-04 09:00:00")])
    h = scd2_backfill(s, CARDS)
    assert rows_of(h, "account_num", "start_dt", "end_dt") == [
        ("A", "2024-01-01 09:00:00", "2024-01-02 09:00:00"),
        ("A", "2024-01-03 09:00:00", None),
        ("B", "2024-01-02 09:00:00", "2024-01-03 09:00:00")]


def test_scd1_update_insert_passthrough(spark):
    dim = spark.createDataFrame([("C1", "A", t("2024-01-01 09:00:00"), None),
                                 ("C2", "X", t("2024-01-01 09:00:00"), None)], H1)
    v = day_vars(spark, [("C1", "B", "2024-01-02 10:00:00"), ("C3", "Z", "2024-01-02 12:00:00")])
    out = scd1_upsert(dim, v, CARDS)
    assert rows_of(out, "card_num", "account_num", "create_dt", "update_dt") == [
        ("C1", "B", "2024-01-01 09:00:00", "2024-01-02 10:00:00"),
        ("C2", "X", "2024-01-01 09:00:00", None),
        ("C3", "Z", "2024-01-02 12:00:00", None)]


def test_scd1_null_attribute_is_not_a_change(spark):
    dim = spark.createDataFrame([("C1", None, t("2024-01-01 09:00:00"), None)], H1)
    v = day_vars(spark, [("C1", "B", "2024-01-02 10:00:00")])
    out = scd1_upsert(dim, v, CARDS)
    assert rows_of(out, "card_num", "account_num", "update_dt") == [("C1", None, None)]


def test_insert_gates(spark):
    dim = spark.createDataFrame([("C1", "A", t("2024-01-01 09:00:00"), None)], H1)
    v = day_vars(spark, [("C1", "A", "2024-01-02 10:00:00"), ("C2", "Z", "2024-01-02 12:00:00")])
    assert rows_of(insert_missing(dim, v, CARDS, "per_key"), "card_num") == [("C2",)]
    assert insert_missing(dim, v, CARDS, "all_or_nothing").count() == 0
    v2 = day_vars(spark, [("C7", "Q", "2024-01-02 10:00:00"), ("C8", "R", "2024-01-02 12:00:00")])
    assert insert_missing(dim, v2, CARDS, "all_or_nothing").count() == 2
    # literal load: the update still happens, the new key does not enter
    out = scd1_upsert_literal(dim, day_vars(spark, [("C1", "B", "2024-01-02 10:00:00"),
                                                    ("C2", "Z", "2024-01-02 12:00:00")]), CARDS)
    assert rows_of(out, "card_num", "account_num") == [("C1", "B")]


def test_literal_scd2_cards_reinserts_every_day(spark):
    hist = spark.createDataFrame([("C1", "A", t("2024-01-01 09:00:00"), None)], H2)
    v = day_vars(spark, [("C1", "A", "2024-01-02 10:00:00")])
    out = scd2_merge_literal(hist, v, CARDS, not_in_column="account_num")
    # account 'A' is NOT IN the card numbers, so an unchanged card is re-inserted
    assert out.count() == 2 and out.where(F.col("end_dt").isNull()).count() == 2
    fixed = scd2_merge_literal(hist, v, CARDS)
    assert fixed.count() == 1


def test_incremental_replay_equals_closed_form(spark):
    lnd = fixture_landing(spark, SF0001).where(F.col("date") < F.lit("2024-01-08").cast("timestamp_ntz"))
    days = [f"2024-01-0{i}" for i in range(1, 8)]
    for name, spec in DIMS.items():
        h = spark.createDataFrame([], "start_dt timestamp_ntz").select(
            *[F.lit(None).cast("string").alias(c) for c in spec.columns], "start_dt",
            F.lit(None).cast("timestamp_ntz").alias("end_dt"))
        h = h.select(*[F.col(c).cast(lnd.schema[spec.source[c]].dataType) for c in spec.columns],
                     "start_dt", "end_dt")
        d1 = scd1_from_history(h, spec)
        for d in days:
            v = variants(stage(lnd, d)[name], spec)
            h = scd2_merge(h, v, spec).checkpoint()
            d1 = scd1_upsert(d1, v, spec).checkpoint()
        closed = scd2_backfill(stage(lnd, None)[name], spec)
        assert h.exceptAll(closed).count() == 0 and closed.exceptAll(h).count() == 0, name
        c1 = scd1_backfill(stage(lnd, None)[name], spec)
        assert d1.exceptAll(c1).count() == 0 and c1.exceptAll(d1).count() == 0, name
        # SCD1 attributes == SCD2 current attributes
        assert current(h).select(*spec.columns).exceptAll(d1.select(*spec.columns)).count() == 0


def test_scd1_two_variants_in_a_day(spark):
    """D2: variants are chained by first-seen time; the last one wins and
    update_dt is its time. A new key with two variants is inserted once."""
    dim = spark.createDataFrame([("C1", "A", t("2024-01-01 09:00:00"), None)], H1)
    v = day_vars(spark, [("C1", "B", "2024-01-02 10:00:00"), ("C1", "C", "2024-01-02 11:00:00"),
                         ("C2", "X", "2024-01-02 08:00:00"), ("C2", "Y", "2024-01-02 12:00:00")])
    out = scd1_upsert(dim, v, CARDS)
    assert rows_of(out, "card_num", "account_num", "create_dt", "update_dt") == [
        ("C1", "C", "2024-01-01 09:00:00", "2024-01-02 11:00:00"),
        ("C2", "Y", "2024-01-02 08:00:00", "2024-01-02 12:00:00")]

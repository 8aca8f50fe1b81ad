"""Audit ("meta") rows: how many rows a day's load inserted and updated.

Each audit reads its table once: one filtered aggregate with two
conditional counts, turned into rows with ``stack``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACTION_INSERTED, ACTION_UPDATED, ts_literal
from ..functions import on_day


def _two_counts(df: DataFrame, table: str, ins_col: str, upd_col: str | None, d, run_ts) -> DataFrame:
    ins, upd = on_day(ins_col, d), (on_day(upd_col, d) if upd_col else F.lit(False))
    counts = df.where(ins | upd).agg(
        F.count_if(ins).alias("_ins"), F.count_if(upd).alias("_upd"))
    rows = [(ACTION_INSERTED, "_ins")] + ([(ACTION_UPDATED, "_upd")] if upd_col else [])
    stack = "stack({n}, {items}) AS (action, amount)".format(
        n=len(rows), items=", ".join(f"'{a}', {c}" for a, c in rows))
    return counts.selectExpr(stack).select(
        F.lit(table).alias("table_name"), "action", F.col("amount").cast("int").alias("amount"),
        ts_literal(run_ts).alias("action_date"))


def audit_scd1(dim: DataFrame, table: str, d: date | str, run_ts: str) -> DataFrame:
    """INSERTED = rows created on ``d``, UPDATED = rows updated on ``d``.
    Must be taken right after that day's load (``update_dt`` moves later)."""
    return _two_counts(dim, table, "create_dt", "update_dt", d, run_ts)


def audit_scd2(hist: DataFrame, table: str, d: date | str, run_ts: str) -> DataFrame:
    """INSERTED = versions started on ``d`` (a change counts here too),
    UPDATED = versions closed on ``d``."""
    return _two_counts(hist, table, "start_dt", "end_dt", d, run_ts)


def audit_fact(fact: DataFrame, d: date | str, run_ts: str, table: str = "transactions") -> DataFrame:
    """INSERTED = fact rows of day ``d`` (the fact has no UPDATED row)."""
    return _two_counts(fact, table, "trans_date", None, d, run_ts)

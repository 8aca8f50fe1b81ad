"""Physical-plan checks: pushdown, no Cartesian products, no Python in the
hot path, one exchange per sequence."""

import io
from contextlib import redirect_stdout

from conftest import SF0001
from ledgerhawk.plans import registry


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_report_plan(spark):
    p = plan(registry.q_report_day_scd1(spark, SF0001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00)" in p or \
        "GreaterThanOrEqual(ts,2024-01-15" in p
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p


def test_all_registered_queries_avoid_cartesian_and_python(spark):
    for name, q in registry.build().items():
        p = plan(q(spark, SF0001))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in p, (name, bad)


def test_column_pruning_reaches_scan(spark):
    p = plan(registry.q_busy_cards(spark, SF0001))
    scans = [ln for ln in p.splitlines() if ln.strip().startswith("ReadSchema") and "value" in ln]
    assert all("props" not in ln for ln in scans)


def test_one_fact_exchange_per_sequence(spark, tmp_path):
    """With broadcasts off: the sequence of rule 3 and of rule 4 is one exchange of
    the operations on (card, day)."""
    from pyspark.sql import functions as F

    from ledgerhawk.config import REFERENCE_DOMAINS
    from ledgerhawk.operators import rule_amount_probe, rule_city_hop
    from ledgerhawk.sources import fixture_landing
    from ledgerhawk.operators import stage

    st = stage(fixture_landing(spark, SF0001), None)
    st["transactions"].drop("load_dt").write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dims = {}
    for n in ("cards", "accounts", "clients", "terminals"):
        st[n].drop("load_dt").dropDuplicates([st[n].columns[0]]).write.parquet(str(tmp_path / n))
        dims[n] = spark.read.parquet(str(tmp_path / n))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
        for rule in (rule_city_hop(fact, dims, now), rule_amount_probe(fact, dims, now, REFERENCE_DOMAINS)):
            text = plan(rule)
            main = text.split("===== Subqueries =====")[0]
            # operations (with their time) are exchanged on (card, day) once; the boundary table of hot
            # groups has other columns, and what decides the ranges is in subqueries
            nodes = [n for n in main.split("\n\n") if "hashpartitioning(card_num" in n and "day" in n]
            rows = [n for n in nodes if "trans_id" in n.split("Input", 1)[1].split("]", 2)[1]]
            assert len(rows) == 1 and "_range" in rows[0], nodes
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

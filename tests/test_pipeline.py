"""Warehouse jobs end to end: backfill, a daily run on top, idempotent
re-runs, audit relations and golden report counts (FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ledgerhawk.config import FIXTURE_DOMAINS
from ledgerhawk.plans.daily import run_day
from ledgerhawk.plans.etl import backfill
from ledgerhawk.plans.report import report_range
from ledgerhawk.sources import fixture_landing
from ledgerhawk.sources.warehouse import Warehouse

DAY = "2024-01-15"


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    lnd = fixture_landing(spark, SF0001).withColumn("batch_dt", F.to_date("date")).where(F.col("batch_dt") <= DAY)
    lnd.write.partitionBy("batch_dt").parquet(root + "/landing")
    for mode in ("scd1", "scd2"):
        backfill(spark, root, "2024-01-01", "2024-01-14", mode)
        run_day(spark, root, DAY, mode, domains=FIXTURE_DOMAINS)
    return root


def counts(rep):
    return sorted((r.fraud_type, r["count"]) for r in rep.groupBy("fraud_type").count().collect())


def test_golden_report_counts(spark, warehouse):
    for mode in ("scd1", "scd2"):
        rep = Warehouse(spark, warehouse, mode).read_report(DAY)
        by_type = dict(counts(rep))
        assert sorted(by_type.values()) == [5, 7, 9], mode  # rules 1/2/3 = 5/9/7, rule 4 = 0


def test_modes_agree(spark, warehouse):
    a = Warehouse(spark, warehouse, "scd1").read_report(DAY).drop("report_dt")
    b = Warehouse(spark, warehouse, "scd2").read_report(DAY).drop("report_dt")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rerun_is_idempotent(spark, warehouse):
    wh = Warehouse(spark, warehouse, "scd2")
    before = (wh.read_report(DAY).count(), wh.read_fact(DAY).count(), wh.read_audit(DAY).count(),
              wh.read_hist("clients", DAY).count())
    run_day(spark, warehouse, DAY, "scd2", domains=FIXTURE_DOMAINS)
    after = (wh.read_report(DAY).count(), wh.read_fact(DAY).count(), wh.read_audit(DAY).count(),
             wh.read_hist("clients", DAY).count())
    assert before == after


def test_audit_relations(spark, warehouse):
    a1 = {(r.table_name, r.action): r.amount for r in Warehouse(spark, warehouse, "scd1").read_audit(DAY).collect()}
    a2 = {(r.table_name, r.action): r.amount for r in Warehouse(spark, warehouse, "scd2").read_audit(DAY).collect()}
    for t in ("clients", "accounts", "cards", "terminals"):
        assert a1[(t, "UPDATED")] == a2[(t, "UPDATED")]
        assert a1[(t, "INSERTED")] == a2[(t, "INSERTED")] - a2[(t, "UPDATED")]
    assert a1[("transactions", "INSERTED")] == 26
    assert a2[("terminals", "INSERTED")] == 1 and a2[("terminals", "UPDATED")] == 1


def test_dimension_counts_and_history(spark, warehouse):
    wh1, wh2 = Warehouse(spark, warehouse, "scd1"), Warehouse(spark, warehouse, "scd2")
    for name in ("clients", "accounts", "cards", "terminals"):
        s1 = wh1.read_dim(name, DAY)
        cur = wh2.read_open(name, DAY)
        cols = [c for c in s1.columns if c not in ("create_dt", "update_dt")]
        assert s1.select(cols).exceptAll(cur.select(cols)).count() == 0
        assert cur.select(cols).exceptAll(s1.select(cols)).count() == 0
        # K6: one open version per key, contiguous history
        from ledgerhawk.operators import history_violations
        from ledgerhawk.schemas import DIMS
        assert history_violations(wh2.read_hist(name, DAY), DIMS[name].key).count() == 0


@pytest.mark.parametrize("mode", ["scd1", "scd2"])
def test_report_range_matches_daily(spark, warehouse, mode):
    wh = Warehouse(spark, warehouse, mode)
    daily = wh.read_report(DAY).drop("report_dt", "load_dt").collect()
    report_range(spark, warehouse, "2024-01-15", "2024-01-15", mode, FIXTURE_DOMAINS)
    rng = wh.read_report(DAY).drop("report_dt", "load_dt").collect()
    assert sorted(map(tuple, daily)) == sorted(map(tuple, rng))
    assert sorted(dict(counts(wh.read_report(DAY))).values()) == [5, 7, 9]


def test_catalog_tables_and_state_views(spark, warehouse):
    from ledgerhawk.sources.catalog import init_warehouse, register_state_views
    names = init_warehouse(spark, warehouse, "scd2", database="lh_test", recreate=True)
    assert "`lh_test`.`report`" in names
    n = spark.sql("SELECT count(*) FROM lh_test.report WHERE load_dt = DATE'2024-01-15'").first()[0]
    assert n == 21
    register_state_views(spark, warehouse, DAY, "scd2")
    cur = spark.sql("SELECT count(*) FROM dim_terminals_hist WHERE end_dt IS NULL").first()[0]
    assert cur == 10


@pytest.mark.skipif(not __import__("os").environ.get("LH_SLOW"), reason="30-day replay; set LH_SLOW=1")
def test_literal_modes_golden_counts_sf001(spark, tmp_path):
    """FIXTURES.md §3 'literal' semantics at sf0.01 (day-by-day replay)."""
    from conftest import SF001
    from ledgerhawk.plans.daily import days_between
    from ledgerhawk.plans.etl import run_etl
    root = str(tmp_path)
    fixture_landing(spark, SF001).withColumn("batch_dt", F.to_date("date")).write \
        .partitionBy("batch_dt").parquet(root + "/landing")
    for d in days_between("2024-01-01", "2024-01-30"):
        run_etl(spark, root, d, "scd1", gate="all_or_nothing")
        run_etl(spark, root, d, "scd2", gate="literal")
    w1, w2 = Warehouse(spark, root, "scd1"), Warehouse(spark, root, "scd2")
    assert {n: w1.read_dim(n, "2024-01-30").count() for n in ("clients", "accounts", "cards", "terminals")} == \
        {"clients": 134, "accounts": 268, "cards": 134, "terminals": 100}
    h = w2.read_hist("cards", "2024-01-30")
    assert h.count() == 6853 and h.where("end_dt IS NULL").count() == 4006
    assert h.groupBy("card_num", "start_dt").count().where("count > 1").count() == 212


def test_as_of_reads_inside_a_backfill(spark, warehouse):
    """After a backfill only its last day has an open snapshot; earlier days
    are rebuilt from the stored versions and match the closed form."""
    from ledgerhawk.operators import scd2_backfill, stage
    from ledgerhawk.operators.scd import hist_as_of
    from ledgerhawk.schemas import DIMS
    wh = Warehouse(spark, warehouse, "scd2")
    lnd = fixture_landing(spark, SF0001)
    for name in ("clients", "cards"):
        exp = hist_as_of(scd2_backfill(stage(lnd, None)[name], DIMS[name]), "2024-01-07")
        got = wh.read_hist(name, "2024-01-07")
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
        assert wh.read_open(name, "2024-01-07").count() == exp.where("end_dt IS NULL").count()


def test_day_without_a_batch(spark, warehouse):
    """No landing batch for the day: dimensions carry over unchanged, the
    audit counts zero and the report is empty."""
    empty_day = "2024-02-10"
    for mode in ("scd1", "scd2"):
        run_day(spark, warehouse, empty_day, mode)
        wh = Warehouse(spark, warehouse, mode)
        assert wh.read_report(empty_day).count() == 0
        assert {r.amount for r in wh.read_audit(empty_day).collect()} == {0}
    wh1 = Warehouse(spark, warehouse, "scd1")
    a, b = wh1.read_dim("clients", DAY), wh1.read_dim("clients", empty_day)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    wh2 = Warehouse(spark, warehouse, "scd2")
    assert wh2.read_open("cards", empty_day).count() == wh2.read_open("cards", DAY).count()


def test_rerun_inside_backfilled_range(spark, tmp_path):
    """SCD2: a day inside a backfilled range can be re-run (its input is
    checkpointed first) and leaves the history unchanged. SCD1: the state of
    the day before is not stored, so the run is refused."""
    from ledgerhawk.plans.etl import run_etl
    root = str(tmp_path)
    fixture_landing(spark, SF0001).withColumn("batch_dt", F.to_date("date")).write \
        .partitionBy("batch_dt").parquet(root + "/landing")
    backfill(spark, root, "2024-01-01", "2024-01-10", "scd2")
    wh = Warehouse(spark, root, "scd2")
    before = wh.read_hist("clients", "2024-01-10").collect()
    run_etl(spark, root, "2024-01-06", "scd2")
    after = wh.read_hist("clients", "2024-01-10").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))
    backfill(spark, root, "2024-01-01", "2024-01-10", "scd1")
    with pytest.raises(ValueError):
        run_etl(spark, root, "2024-01-06", "scd1")


def test_rerun_first_day_is_allowed(spark, tmp_path):
    from ledgerhawk.plans.etl import run_etl
    root = str(tmp_path)
    fixture_landing(spark, SF0001).where(F.to_date("date") <= F.lit("2024-01-02").cast("date")) \
        .withColumn("batch_dt", F.to_date("date")).write.partitionBy("batch_dt").parquet(root + "/landing")
    for d in ("2024-01-01", "2024-01-02", "2024-01-01"):
        run_etl(spark, root, d, "scd1")
    assert Warehouse(spark, root, "scd1").read_dim("terminals", "2024-01-01").count() > 0


@pytest.mark.parametrize("mode", ["scd1", "scd2"])
def test_backfill_equals_daily_replay(spark, tmp_path, mode):
    """One-pass backfill == run_etl day by day: same dimension state and the
    same audit rows for every day."""
    from ledgerhawk.plans.daily import days_between
    from ledgerhawk.plans.etl import run_etl
    lnd = fixture_landing(spark, SF0001).withColumn("batch_dt", F.to_date("date"))
    roots = [str(tmp_path / "daily"), str(tmp_path / "backfill")]
    for r in roots:
        lnd.write.partitionBy("batch_dt").parquet(r + "/landing")
    for d in days_between("2024-01-01", "2024-01-05"):
        run_etl(spark, roots[0], d, mode)
    backfill(spark, roots[1], "2024-01-01", "2024-01-05", mode)
    a, b = (Warehouse(spark, r, mode) for r in roots)
    x, y = a.read_audit().drop("action_date"), b.read_audit().drop("action_date")
    assert x.count() == 45 and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    for name in ("clients", "accounts", "cards", "terminals"):
        if mode == "scd1":
            s, t = a.read_dim(name, "2024-01-05"), b.read_dim(name, "2024-01-05")
        else:
            s, t = a.read_hist(name, "2024-01-05"), b.read_hist(name, "2024-01-05")
        assert s.exceptAll(t).count() == 0 and t.exceptAll(s).count() == 0, name


HEADER = "trans_id string, date timestamp_ntz, card string, account string, client string, amount decimal(10,2), " \
         "oper_type string, oper_result string, terminal string, last_name string, first_name string, " \
         "patronymic string, date_of_birth timestamp_ntz, passport string, passport_valid_to timestamp_ntz, " \
         "phone string, account_valid_to timestamp_ntz, terminal_type string, city string, address string"


def operation(i, t, card="C1", oper_type="Оплата", result="Успешно", amount=1, passport_to="2024-01-01"):
    from datetime import datetime
    from decimal import Decimal
    day = datetime.fromisoformat
    return (str(i), day(t), card, "A" + card, "K" + card, Decimal(amount), oper_type, result, "T1", "L", "F", "P",
            day("1980-01-01"), "PP" + card, day(passport_to), "+7", day("2030-01-01"), "ATM", "City", "Street")


def land_rows(spark, root, day, rows):
    from ledgerhawk.sources import land
    land(spark.createDataFrame(rows, HEADER), root, day)


@pytest.mark.parametrize("mode", ["scd1", "scd2"])
def test_corrected_smaller_batch_replaces_all_output(spark, tmp_path, mode):
    root, wh = str(tmp_path), Warehouse(spark, str(tmp_path), mode)
    land_rows(spark, root, "2024-05-01", [operation(1, "2024-05-01 10:00"), operation(2, "2024-05-01 11:00", "C2")])
    run_day(spark, root, "2024-05-01", mode)
    assert wh.read_fact("2024-05-01").count() == 2 and wh.read_report("2024-05-01").count() == 2
    land_rows(spark, root, "2024-05-01", [operation(1, "2024-05-01 10:00", oper_type="Снятие",
                                                    passport_to="2030-01-01")])
    run_day(spark, root, "2024-05-01", mode)
    assert [r.oper_type for r in wh.read_fact("2024-05-01").collect()] == ["Снятие"]
    assert wh.read_report("2024-05-01").count() == 0
    audit = {(r.table_name, r.action): r.amount for r in wh.read_audit("2024-05-01").collect()}
    assert audit[("transactions", "INSERTED")] == 1 and audit[("cards", "INSERTED")] == 1
    land_rows(spark, root, "2024-05-01", [])  # an emptied day
    run_day(spark, root, "2024-05-01", mode)
    assert wh.read_fact("2024-05-01").count() == 0 and wh.read_fact().count() == 0


@pytest.mark.parametrize("mode", ["scd1", "scd2"])
def test_reloading_a_past_day_invalidates_later_days(spark, tmp_path, mode):
    from ledgerhawk.plans.etl import run_etl
    from ledgerhawk.plans.report import run_report
    root, wh = str(tmp_path), Warehouse(spark, str(tmp_path), mode)
    for d in ("01", "02", "03"):
        land_rows(spark, root, f"2024-05-{d}", [operation(d, f"2024-05-{d} 10:00", "C" + d)])
    with pytest.raises(ValueError):  # the batch before is not loaded
        run_etl(spark, root, "2024-05-02", mode)
    for d in ("01", "02", "03"):
        run_etl(spark, root, f"2024-05-{d}", mode)
    land_rows(spark, root, "2024-05-01", [operation("01", "2024-05-01 10:00", "C9")])
    run_etl(spark, root, "2024-05-01", mode)
    for job in (run_report, run_etl):
        with pytest.raises(ValueError):
            job(spark, root, "2024-05-03", mode)
    run_etl(spark, root, "2024-05-02", mode)
    read = wh.read_dim if mode == "scd1" else wh.read_open
    assert {r.card_num for r in read("cards", "2024-05-02").collect()} == {"C9", "C02"}


def test_sub_range_and_report_inside_a_backfill(spark, tmp_path):
    from ledgerhawk.plans.report import run_report
    root = str(tmp_path)
    for d in ("01", "02", "03", "04"):
        land_rows(spark, root, f"2024-05-{d}", [operation(d, f"2024-05-{d} 10:00", "C" + d)])
    for mode in ("scd1", "scd2"):
        backfill(spark, root, "2024-05-01", "2024-05-04", mode)
    with pytest.raises(ValueError):  # scd1 stores no state of that day
        run_report(spark, root, "2024-05-02", "scd1")
    report_range(spark, root, "2024-05-02", "2024-05-02", "scd1")
    assert Warehouse(spark, root, "scd1").read_report("2024-05-02").count() == 1
    run_report(spark, root, "2024-05-02", "scd2")
    assert Warehouse(spark, root, "scd2").read_report("2024-05-02").count() == 1
    with pytest.raises(ValueError):
        backfill(spark, root, "2024-05-03", "2024-05-04", "scd1")
    backfill(spark, root, "2024-05-03", "2024-05-04", "scd2")
    assert Warehouse(spark, root, "scd2").read_open("cards", "2024-05-04").count() == 4


def test_failed_dimension_job_leaves_the_day_as_it_was(spark, tmp_path, monkeypatch):
    from ledgerhawk.plans import etl
    from ledgerhawk.plans.report import run_report
    root = str(tmp_path)
    land_rows(spark, root, "2024-05-01", [operation(1, "2024-05-01 10:00")])
    load = etl.load_dimension

    def broken(wh, name, *rest):
        if name == "cards":
            raise RuntimeError("lost")
        return load(wh, name, *rest)

    monkeypatch.setattr(etl, "load_dimension", broken)
    with pytest.raises(RuntimeError):
        etl.run_etl(spark, root, "2024-05-01")
    with pytest.raises(ValueError):  # never loaded
        run_report(spark, root, "2024-05-01")
    monkeypatch.setattr(etl, "load_dimension", load)
    etl.run_etl(spark, root, "2024-05-01")
    monkeypatch.setattr(etl, "load_dimension", broken)
    with pytest.raises(RuntimeError):
        etl.run_etl(spark, root, "2024-05-01")
    run_report(spark, root, "2024-05-01")  # on what was published before
    assert Warehouse(spark, root).read_report("2024-05-01").count() == 1


def test_rule_4_on_reference_values_by_default(spark, tmp_path):
    root = str(tmp_path)
    rows = [operation(i, f"2024-05-01 10:0{i}", result="Успешно" if i == 4 else "Отказ", amount=100 - i,
                      passport_to="2030-01-01") for i in range(1, 5)]
    land_rows(spark, root, "2024-05-01", rows)
    run_day(spark, root, "2024-05-01")
    assert [r.fraud_type for r in Warehouse(spark, root).read_report("2024-05-01").collect()] == ["Попытка подбора сумм"]


def test_quality_counts_of_a_day(spark, tmp_path):
    """Violations beside clean rows: an unknown client, a value outside its domain, a NULL amount."""
    root = str(tmp_path)
    good, bad = operation(1, "2024-05-01 10:00"), list(operation(2, "2024-05-01 11:00", "C2", oper_type="gift"))
    bad[4], bad[5] = None, None  # client and amount
    land_rows(spark, root, "2024-05-01", [good, tuple(bad)])
    run_day(spark, root, "2024-05-01")
    n = {(r.check_name, r.table_name, r.column_name): r.n_rows
         for r in Warehouse(spark, root).read_quality("2024-05-01").collect()}
    assert n[("orphans", "cards", "account_num")] == 1 and n[("orphans", "transactions", "card_num")] == 0
    assert n[("domain", "transactions", "oper_type")] == 1 and n[("domain", "transactions", "oper_result")] == 0
    assert n[("null", "transactions", "amt")] == 1 and n[("null", "clients", "phone")] == 0
    assert n[("duplicate_keys", "cards", "card_num")] == 0 and ("width", "terminals", "terminal_address") in n

"""One day is one unit: a failure in any job changes nothing that readers see; stale days are not
served; the landing takes all writers; the fact has a primary key."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerhawk.operators.keys import FACT_KEY, blooms, key_rows, may_hold, repeated_in
from ledgerhawk.plans import daily, etl
from ledgerhawk.plans.daily import run_day
from ledgerhawk.plans.etl import backfill, run_etl
from ledgerhawk.sources import land, land_many, read_landing
from ledgerhawk.sources.manifest import ConcurrentLoad
from ledgerhawk.sources.warehouse import Warehouse
from ledgerhawk.streaming import start_daily_file_stream
from test_pipeline import HEADER, land_rows, operation

DAYS = ("2024-05-01", "2024-05-02")


def seen(wh):
    """Everything that readers get, as comparable rows."""
    dims = [wh.read_dim if wh.mode == "scd1" else wh.read_hist][0]
    frames = [wh.read_fact(), wh.read_report().drop("report_dt"), wh.read_audit().drop("action_date"),
              wh.read_quality(), wh.read_quarantine().drop("bad_cells")]
    frames += [dims(n, d) for n in ("clients", "cards") for d in DAYS]
    return [sorted(map(str, f.collect())) for f in frames]


def land_two_days(spark, root, city="City"):
    for k, d in enumerate(DAYS):
        land_rows(spark, root, d, [operation(f"{k}-{i}", f"{d} 10:0{i}", f"C{i}")[:-2] + (city, "Street") for i in range(3)])


JOBS = [("load_dimension", "scd2"), ("write_key_index", "scd1"), ("quarantined", "scd1"), ("audit_fact", "scd1"),
        ("report_day", "scd2"), ("quality_day", "scd1"), ("publish", "scd2")]


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """Both days loaded in each mode, then landed again with other rows; what readers saw before."""
    root, before = str(tmp_path_factory.mktemp("atomic")), {}
    land_two_days(spark, root)
    for mode in ("scd1", "scd2"):
        for d in DAYS:
            run_day(spark, root, d, mode)
        before[mode] = seen(Warehouse(spark, root, mode))
        assert len(before[mode][0]) == 6 and before[mode][1]
    land_two_days(spark, root, "Elsewhere")
    return root, before


@pytest.mark.parametrize("job,mode", JOBS)
def test_failure_in_any_job_leaves_readers_on_the_old_version(spark, two_days, monkeypatch, job, mode):
    root, before = two_days
    wh = Warehouse(spark, root, mode)

    def broken(*_, **__):
        raise RuntimeError("lost")

    module = {"report_day": daily, "quality_day": daily, "publish": Warehouse}.get(job, etl)
    monkeypatch.setattr(module, job, broken)
    with pytest.raises(RuntimeError):
        run_day(spark, root, DAYS[0], mode)
    assert seen(wh) == before[mode] and wh.loaded_as(DAYS[0]) == wh.loaded_as(DAYS[1]) == "state"


def test_stale_days_are_not_served(spark, two_days):
    """After the failures above: loading day 1 again makes day 2 stale until it is loaded again."""
    root, _ = two_days
    wh = Warehouse(spark, root)
    run_day(spark, root, DAYS[0])
    assert wh.loaded_as(DAYS[0]) == "state" and wh.loaded_as(DAYS[1]) is None
    assert {r.trans_id[0] for r in wh.read_fact().collect()} == {"0"}
    assert {str(r.load_dt) for f in (wh.read_report(), wh.read_audit(), wh.read_quality()) for r in f.collect()} == {DAYS[0]}
    assert wh.read_report(DAYS[1]).count() == 0 and {r.terminal_city for r in wh.read_dim("terminals", DAYS[1]).collect()} == {"Elsewhere"}
    assert wh.vacuum(older_than_hours=0) > 0 and wh.vacuum(older_than_hours=0) == 0
    run_day(spark, root, DAYS[1])
    assert wh.read_fact().count() == 6


def test_two_loads_at_once_publish_one(spark, tmp_path):
    root = str(tmp_path)
    land_two_days(spark, root)
    one, two = Warehouse(spark, root).begin(), Warehouse(spark, root).begin()
    for wh in (one, two):
        etl.load_day(wh, date(2024, 5, 1), "2024-05-02 00:00:00")
    assert Warehouse(spark, root).read_fact().count() == 0 and one.read_fact().count() == 3
    one.publish()
    with pytest.raises(ConcurrentLoad):
        two.publish()
    assert Warehouse(spark, root).read_fact().count() == 3


def csv(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("trans_id,date,card,account,client,amount,oper_type,oper_result,terminal\n")
        f.writelines(",".join(r) + "\n" for r in rows)
    return path


def row(i, t, card="C1"):
    return (str(i), t, card, "A" + card, "K" + card, "1", "Оплата", "Успешно", "T1")


def test_all_writers_share_one_landing(spark, tmp_path):
    """land + late file of the stream + land again + backfill + run_day on one root."""
    root, inbox, ckpt = str(tmp_path / "wh"), str(tmp_path / "in"), str(tmp_path / "ck")
    day = DAYS[0]
    for d in DAYS:
        land_rows(spark, root, d, [operation("f" + d[-1], f"{d} 10:00")])
    csv(f"{inbox}/late.csv", row("s1", f"{day} 12:00:00"))
    start_daily_file_stream(spark, inbox, root, ckpt).awaitTermination(300)
    ids = lambda d=None: sorted(r.trans_id for r in read_landing(spark, root, d).collect())
    assert ids() == ["f1", "f2", "s1"] and ids(day) == ["f1", "s1"]
    wh = Warehouse(spark, root)
    assert sorted(r.trans_id for r in wh.read_fact(day).collect()) == ["f1", "s1"]
    land_rows(spark, root, day, [operation("g1", f"{day} 10:00")])  # a corrected batch: the stream's row stays
    assert ids(day) == ["g1", "s1"]
    land_many(spark, {csv(str(tmp_path / "x/a.csv"), row("m2", f"{DAYS[1]} 9:00:00")): DAYS[1]}, root, "csv")
    assert ids() == ["g1", "m2", "s1"]
    csv(f"{inbox}/more.csv", row("s2", f"{DAYS[1]} 12:00:00"), row("s3", f"{day} 13:00:00"))
    start_daily_file_stream(spark, inbox, root, ckpt).awaitTermination(300)
    assert ids(day) == ["g1", "s1", "s3"] and ids(DAYS[1]) == ["m2", "s2"]
    backfill(spark, root, *DAYS, "scd2")
    run_day(spark, root, DAYS[1], "scd2")
    assert Warehouse(spark, root, "scd2").read_fact().count() == 5


def test_layouts_of_older_releases_are_read(spark, tmp_path):
    root, day = str(tmp_path), DAYS[0]
    rows = spark.createDataFrame([operation("old", f"{day} 10:00")], HEADER)
    rows.write.parquet(f"{root}/landing/batch_dt={day}")
    rows.withColumn("trans_id", F.lit("e0")).write.parquet(f"{root}/landing/batch_dt={day}/epoch=0")
    assert sorted(r.trans_id for r in read_landing(spark, root, day).collect()) == ["e0", "old"]
    land(rows.withColumn("trans_id", F.lit("new")), root, day)
    assert sorted(r.trans_id for r in read_landing(spark, root).collect()) == ["e0", "new"]


@pytest.mark.parametrize("mode", ["daily", "range", "mixed"])
def test_repeated_keys_are_quarantined(spark, tmp_path, mode):
    """Within a batch, against days before, and in a backfill; the first operation stays."""
    a, b, c = DAYS[0], DAYS[1], "2024-05-03"

    def land_all(root):
        land_rows(spark, root, a, [operation(1, f"{a} 10:00"), operation(1, f"{a} 10:00"), operation(1, f"{a} 09:00", "C2"),
                                   operation(1, f"{a} 11:00", result="Отказ"), operation(2, f"{a} 12:00")])
        land_rows(spark, root, b, [operation(2, f"{b} 10:00", "C9"), operation(3, f"{b} 10:00"),
                                   (None, *operation(0, f"{b} 11:00")[1:]), (None, *operation(0, f"{b} 12:00")[1:])])
        land_rows(spark, root, c, [operation(3, f"{c} 08:00"), operation(1, f"{c} 08:00"), operation(4, f"{c} 08:00")])

    root = str(tmp_path)
    land_all(root)
    if mode == "daily":
        for d in (a, b, c):
            run_day(spark, root, d)
    elif mode == "range":
        backfill(spark, root, a, c, "scd2")
    else:
        backfill(spark, root, a, b)
        run_day(spark, root, c)
    for wh in [Warehouse(spark, root, "scd2" if mode == "range" else "scd1")]:
        fact = sorted((str(x.trans_id), str(x.trans_date), x.oper_result) for x in wh.read_fact().collect())
        assert fact == sorted([("1", f"{a} 09:00:00", "Успешно"), ("1", f"{a} 11:00:00", "Отказ"), ("2", f"{a} 12:00:00", "Успешно"),
                               ("3", f"{b} 10:00:00", "Успешно"), ("None", f"{b} 11:00:00", "Успешно"),
                               ("None", f"{b} 12:00:00", "Успешно"), ("4", f"{c} 08:00:00", "Успешно")])
        kept_out = wh.read_quarantine().where("reason like '%duplicate_key%'")
        assert sorted((str(x.load_dt), x.trans_id) for x in kept_out.collect()) == \
            [(a, "1"), (a, "1"), (b, "2"), (c, "1"), (c, "3")]
    n = {str(r.load_dt): r.n_rows for r in wh.read_quality().where(
        "check_name = 'duplicate_keys' and table_name = 'transactions'").collect()}
    assert n == {a: 2, b: 1, c: 2}


def test_filters_never_miss_and_prune_days(spark):
    keys = key_rows(spark.range(3000).select(
        F.concat(F.lit("t"), "id").alias("trans_id"), F.lit("x").alias("oper_type"), F.lit("y").alias("oper_result"),
        F.expr("date_add(date'2024-01-01', cast(id % 3 as int))").alias("load_dt")), "load_dt")
    filters = blooms(keys)
    sizes = [r[0] for r in filters.select("slices").distinct().collect()]
    assert sizes == [4] and filters.count() == 12  # 1,000 keys a day
    held = may_hold(keys.drop("load_dt"), filters, sizes).join(keys.select("h", F.col("load_dt").alias("own")), "h")
    assert held.where("load_dt = own").count() == 3000
    assert held.where("load_dt <> own").count() < 60  # false positives
    other = key_rows(spark.range(300).select(F.concat(F.lit("n"), "id").alias("trans_id"), F.lit("x").alias("oper_type"),
                                             F.lit("y").alias("oper_result")))
    assert may_hold(other, filters, sizes).count() < 20  # of 900 probes


def test_repeated_in_keeps_the_first_of_each_key(spark):
    rows = spark.createDataFrame([(k % 7, k) for k in range(100)] + [(None, 1), (None, 2)], "trans_id int, at int") \
        .withColumn("oper_type", F.lit("x")).withColumn("oper_result", F.lit("y"))
    found = repeated_in(rows, ["at"]).select("at").collect()
    assert sorted(r[0] for r in found) == list(range(7, 100)) and FACT_KEY[0] == "trans_id"


def test_first_day_again_reads_no_index(spark, tmp_path):
    root = str(tmp_path)
    land_rows(spark, root, DAYS[0], [operation(1, f"{DAYS[0]} 10:00")])
    for _ in range(2):  # its own former facts are no duplicates
        run_etl(spark, root, DAYS[0])
        assert Warehouse(spark, root).read_fact().count() == 1

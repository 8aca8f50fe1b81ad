"""Landing: conform, blank rows, typing rejects, late split, idempotent land."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ledgerhawk.schemas import LANDING
from ledgerhawk.sources import cast_rejects, conform, drop_blank, fixture_landing, land, land_many, read_daily, split_late
from ledgerhawk.sources.landing import read_landing


def test_conform_by_name_missing_column_is_null(spark):
    raw = spark.createDataFrame([("2024-01-01 10:00:00", "12.5", "T1", "x")],
                                "DATE string, amount string, terminal string, extra string")
    out = conform(raw)
    assert out.columns == LANDING.fieldNames()
    r = out.first()
    assert str(r.date) == "2024-01-01 10:00:00" and str(r.amount) == "12.50" and r.terminal == "T1"
    assert r.city is None and r.trans_id is None


def test_cast_rejects_lists_bad_cells(spark):
    raw = spark.createDataFrame([("1", "not a date", "5"), ("2", "2024-01-01 00:00:00", "abc"),
                                 ("3", None, "7")], "trans_id string, date string, amount string")
    bad = {r.trans_id: sorted(r.bad_columns) for r in cast_rejects(raw).collect()}
    assert bad == {"1": ["date"], "2": ["amount"]}


def test_drop_blank(spark):
    raw = spark.createDataFrame([("1", "T1"), (None, None)], "trans_id string, terminal string")
    assert drop_blank(conform(raw)).count() == 1


def test_split_late(spark):
    lnd = fixture_landing(spark, SF0001)
    on, off = split_late(lnd, "2024-01-15")
    assert on.count() == 26 and on.count() + off.count() == lnd.count()
    reasons = {r.reason: r["count"] for r in off.groupBy("reason").count().collect()}
    assert set(reasons) == {"late", "early"}


def test_land_is_idempotent_and_land_many_reads_csv(spark, scratch):
    lnd = fixture_landing(spark, SF0001).where(F.to_date("date") == F.lit("2024-01-03").cast("date"))
    n = lnd.count()
    land(lnd, scratch, "2024-01-03")
    land(lnd, scratch, "2024-01-03")
    assert read_landing(spark, scratch, "2024-01-03").count() == n
    csv_dir = os.path.join(scratch, "csv")
    (lnd.coalesce(1).write.option("header", "true")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(csv_dir))
    f = [os.path.join(csv_dir, p) for p in os.listdir(csv_dir) if p.endswith(".csv")][0]
    land_many(spark, {f: "2024-01-04"}, scratch, fmt="csv")
    got = read_landing(spark, scratch, "2024-01-04").drop("batch_dt", "bad_cells")
    assert got.exceptAll(lnd).count() == 0 and lnd.exceptAll(got).count() == 0


def test_read_daily_json_and_parquet(spark, scratch):
    lnd = fixture_landing(spark, SF0001).where(F.to_date("date") == F.lit("2024-01-05").cast("date"))
    n = lnd.count()
    jdir, pdir = os.path.join(scratch, "json"), os.path.join(scratch, "pq")
    (lnd.drop("address").write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(jdir))
    lnd.drop("address").write.parquet(pdir)
    exp = lnd.withColumn("address", F.lit(None).cast("string"))
    for fmt, path in (("json", jdir), ("parquet", pdir)):
        got = read_daily(spark, path, fmt=fmt)
        assert got.columns == LANDING.fieldNames()
        assert got.count() == n
        assert got.exceptAll(exp).count() == 0, fmt


def csv_file(path, header, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(header), *(",".join(x) for x in lines)]) + "\n")
    return str(path)


HEADER = ["trans_id", "date", "card", "account", "client", "amount"]


def test_land_many_keeps_every_row(spark, tmp_path):
    """The same base name in two folders, a name with a space, a folder, swapped columns."""
    files = {
        csv_file(tmp_path / "a/trans.csv", HEADER, ["1", "2024-05-01 10:00:00", "C1", "A1", "K1", "1"]): "2024-05-01",
        csv_file(tmp_path / "b/trans.csv", HEADER, ["2", "2024-05-02 10:00:00", "C2", "A2", "K2", "2"]): "2024-05-02",
        csv_file(tmp_path / "trans 0305.csv", ["card", "trans_id", "date", "account"],
                 ["C3", "3", "2024-05-03 10:00:00", "A3"]): "2024-05-03",
    }
    csv_file(tmp_path / "dir/x.csv", HEADER, ["4", "2024-05-04 10:00:00", "C4", "A4", "K4", "4"])
    csv_file(tmp_path / "dir/y.csv", HEADER, ["5", "2024-05-04 11:00:00", "C5", "A5", "K5", "5"])
    files[str(tmp_path / "dir")] = "2024-05-04"
    root = str(tmp_path / "wh")
    land_many(spark, files, root, fmt="csv")
    got = {(r.trans_id, r.card, r.account, str(r.batch_dt)) for r in read_landing(spark, root).collect()}
    assert got == {("1", "C1", "A1", "2024-05-01"), ("2", "C2", "A2", "2024-05-02"), ("3", "C3", "A3", "2024-05-03"),
                   ("4", "C4", "A4", "2024-05-04"), ("5", "C5", "A5", "2024-05-04")}
    with pytest.raises(FileNotFoundError):
        land_many(spark, {str(tmp_path / "none.csv"): "2024-05-05"}, root, fmt="csv")


def test_rows_in_are_loaded_or_quarantined(spark, tmp_path):
    """Bad cells, NULL keys and rows without a date are kept with a reason."""
    from ledgerhawk.plans.etl import run_etl
    from ledgerhawk.sources.warehouse import Warehouse
    path = csv_file(tmp_path / "in.csv", HEADER,
                    ["1", "2024-05-01 10:00:00", "C1", "A1", "K1", "1"],
                    ["2", "yesterday", "C1", "A1", "K1", "1"],
                    ["3", "2024-05-01 11:00:00", "C1", "A1", "", "1"],
                    ["4", "2024-05-01 12:00:00", "C1", "A1", "K1", "much"],
                    ["5", "2024-05-02 12:00:00", "C1", "A1", "K1", "1"])
    root = str(tmp_path / "wh")
    land(read_daily(spark, path, "csv", bad_cells=True), root, "2024-05-01")
    run_etl(spark, root, "2024-05-01")
    wh = Warehouse(spark, root)
    fact = {r.trans_id for r in wh.read_fact("2024-05-01").collect()}
    q = spark.read.parquet(root + "/scd1/quarantine/load_dt=2024-05-01").collect()
    reason = {r.trans_id: r.reason for r in q}
    assert fact == {"1", "3", "4"} and fact | set(reason) == {"1", "2", "3", "4", "5"}
    assert reason["2"] == "no_date" and reason["5"] == "early"
    assert "null_key:clients" in reason["3"] and "bad_cell" in reason["4"]
    cells = {r.trans_id: r.bad_cells for r in q}
    assert cells["2"] == {"date": "yesterday"} and cells["4"] == {"amount": "much"}

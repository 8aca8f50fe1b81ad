"""Daily files through the file stream give the same warehouse as the batch jobs."""

import os

from pyspark.sql import functions as F

from conftest import SF0001
from ledgerhawk.config import FIXTURE_DOMAINS
from ledgerhawk.sources import fixture_landing
from ledgerhawk.sources.warehouse import Warehouse
from ledgerhawk.streaming import start_daily_file_stream


def test_file_stream_runs_daily_loads(spark, scratch):
    inbox = os.path.join(scratch, "inbox")
    lnd = fixture_landing(spark, SF0001)
    for day in ("2024-01-01", "2024-01-02"):
        (lnd.where(F.to_date("date") == F.lit(day).cast("date")).coalesce(1).write
         .option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
         .csv(os.path.join(inbox, day)))
    q = start_daily_file_stream(spark, os.path.join(inbox, "*"), os.path.join(scratch, "wh"),
                                os.path.join(scratch, "ckpt"), domains=FIXTURE_DOMAINS)
    q.awaitTermination(300)
    wh = Warehouse(spark, os.path.join(scratch, "wh"), "scd1")
    n = lnd.where(F.to_date("date") <= F.lit("2024-01-02").cast("date")).count()
    assert wh.read_fact().count() == n
    assert wh.read_dim("terminals", "2024-01-02").count() == 10
    assert wh.read_audit().count() > 0


def test_stream_reads_columns_by_name_and_keeps_undated_rows(spark, scratch):
    inbox, root = os.path.join(scratch, "inbox"), os.path.join(scratch, "wh")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "d 1.csv"), "w") as f:
        f.write("account,card,trans_id,date\nA1,C1,1,2024-05-01 10:00:00\nA2,C2,2,never\n")
    start_daily_file_stream(spark, inbox, root, os.path.join(scratch, "ckpt")).awaitTermination(300)
    wh = Warehouse(spark, root, "scd1")
    assert [(r.trans_id, r.card_num) for r in wh.read_fact().collect()] == [("1", "C1")]
    lost = spark.read.parquet(root + "/scd1/quarantine_undated").collect()
    assert [(r.trans_id, r.bad_cells) for r in lost] == [("2", {"date": "never"})]

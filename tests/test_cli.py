"""The command line drives the same jobs (in-process, test session)."""

import os

from pyspark.sql import functions as F

from conftest import SF0001
from ledgerhawk.__main__ import main
from ledgerhawk.sources import fixture_landing
from ledgerhawk.sources.warehouse import Warehouse


def test_cli_land_and_run_day(spark, scratch):
    day = "2024-01-02"
    src = os.path.join(scratch, "in")
    (fixture_landing(spark, SF0001).where(F.to_date("date") == F.lit(day).cast("date")).coalesce(1).write
     .option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(src))
    files = [os.path.join(src, f) for f in os.listdir(src) if f.endswith(".csv")]
    root = os.path.join(scratch, "wh")
    assert main(["land", "--root", root, "--day", day, "--file", *files], spark) == 0
    assert main(["run-day", "--root", root, "--day", day, "--mode", "scd2", "--domains", "fixture"], spark) == 0
    wh = Warehouse(spark, root, "scd2")
    assert wh.read_fact(day).count() == len(open(files[0]).read().splitlines()) - 1
    assert wh.read_open("terminals", day).count() == 10

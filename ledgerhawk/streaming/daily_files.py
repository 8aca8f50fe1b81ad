"""Daily files dropped into an inbox directory drive the daily load.

The reference is fed one transaction file per day and then runs the ETL and
the report for that day. Here a file-source stream picks up new files. A
micro-batch has at most ``MAX_FILES`` of them; each is read by its own column
names and landed under ``landing/batch_dt=D/epoch=E`` (so a replayed epoch
overwrites only itself), rows without a date go to ``quarantine_undated/epoch=E``,
and then ``run_day`` runs for every day the batch touched and every later day
that was loaded before, in day order. Progress is kept in the stream checkpoint,
which must be on shared storage.
"""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..config import REFERENCE_DOMAINS, Domains, check_mode
from ..plans.daily import run_day
from ..schemas import LANDING
from ..sources.landing import BATCH_COL, drop_blank, landed_days, read_daily, write_batches
from ..sources.warehouse import Warehouse

MAX_FILES = 31


def _land_epoch(spark: SparkSession, files: list[str], fmt: str, epoch_id: int, root: str, mode: str) -> list:
    rows = drop_blank(read_daily(spark, [unquote(f) for f in files], fmt, bad_cells=True)).withColumn(BATCH_COL, F.to_date("date"))
    (rows.where(F.col(BATCH_COL).isNull()).drop(BATCH_COL).withColumn("reason", F.lit("no_date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{root.rstrip('/')}/{mode}/quarantine_undated/epoch={epoch_id}"))
    dated = rows.where(F.col(BATCH_COL).isNotNull())
    # the days in at most MAX_FILES daily files
    days = sorted(r[0] for r in dated.select(BATCH_COL).distinct().collect())
    write_batches(dated, root, days, f"epoch-{epoch_id}")
    return days


def start_daily_file_stream(spark: SparkSession, inbox: str, root: str, checkpoint: str,
                            mode: str = "scd1", fmt: str = "csv", domains: Domains = REFERENCE_DOMAINS,
                            available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is in the
    inbox and stops (a scheduled daily run), otherwise it keeps polling."""
    check_mode(mode)
    # the stream tells which files are new; their content is read by name, file by file
    reader = spark.readStream.schema(_ANY).option("maxFilesPerTrigger", MAX_FILES)
    src = reader.format("csv" if fmt == "csv" else fmt).load(inbox).select("_metadata.file_path")

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        files = sorted(r[0] for r in df.distinct().collect())
        days = _land_epoch(spark, files, fmt, epoch_id, root, mode) if files else []
        if days:
            wh = Warehouse(spark, root, mode)
            landed = [date.fromisoformat(x) for x in landed_days(spark, root)]
            # a file for an older day: the days after it were built on the old state
            loaded = {x for x in landed if wh.loaded_as(x)}
            for day in [x for x in landed if x >= days[0] and (x in days or x in loaded)]:
                run_day(spark, root, day, mode, domains=domains)

    writer = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


_ANY = StructType([StructField(f.name, StringType()) for f in LANDING.fields])

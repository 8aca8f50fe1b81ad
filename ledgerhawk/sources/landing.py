"""Landing: read one daily transaction file, conform it to the landing
schema, drop blank rows, type it, and append it to the landing area.

No row vanishes on the way: a cell that does not parse into its type is NULL
in its column and kept as text in ``bad_cells``; rows of another day, without a
date, with bad cells, with NULLs that a dimension refuses or with the key of an earlier
operation end up in the quarantine with a reason when their batch is loaded.

All writers share one layout, ``landing/batch_dt=D/part=P``: ``land`` and ``land_many``
own the part ``land`` of a day, the file stream one part per epoch. A writer replaces
its own parts only, so late files of the stream and corrected batches can be mixed
freely. Days that older releases wrote (files directly under the day, or ``epoch=E``) are read as well."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, MapType, StringType, StructField, StructType

from ..config import as_date, day_end, day_start
from ..schemas import DIMS, LANDING, NOT_NULL
from .manifest import hadoop_path

BATCH_COL = "batch_dt"
PART_COL = "part"
#: The part of a day that :func:`land` and :func:`land_many` write.
LAND_PART = "land"
BAD_CELLS = "bad_cells"
BAD_CELLS_FIELD = StructField(BAD_CELLS, MapType(StringType(), StringType()))
#: Where a landing row is stored: (file, row in it).
PLACE = "_place"
LANDING_COLUMNS = [f.name for f in LANDING.fields]


def _read_raw(spark: SparkSession, path: str | list[str], fmt: str, **options: str) -> DataFrame:
    reader = spark.read.options(**options)
    if fmt == "csv":
        # Text is kept as text (no inference); typing happens in conform().
        return reader.option("header", "true").option("inferSchema", "false").csv(path)
    if fmt == "json":
        return reader.option("primitivesAsString", "true").json(path)
    return reader.format(fmt).load(path)


def read_daily(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
               schema: StructType = LANDING, bad_cells: bool = False, **options: str) -> DataFrame:
    """Read daily transaction file(s) and conform them to ``schema``, each by its
    own column names; ``bad_cells`` keeps the text of unparsable cells (what :func:`land` stores)."""
    paths = [path] if isinstance(path, str) else list(path)
    parts = [conform(raw, schema, bad_cells=bad_cells)
             for raw in (_read_raw(spark, p, fmt, **options) for p in paths)]
    return reduce(DataFrame.unionByName, parts)


def conform(df: DataFrame, schema: StructType = LANDING, keep: tuple[str, ...] = (),
            bad_cells: bool = False) -> DataFrame:
    """Select the fixed column list by name; a missing column becomes all-NULL.

    Values are typed with ``try_cast``, so an unparsable cell turns into NULL
    instead of failing the job. With ``bad_cells`` the text of such cells is kept
    in a map of that name (NULL for a clean row; an existing one is carried on);
    :func:`cast_rejects` lists such rows. Columns named in ``keep`` are carried along unchanged."""
    present = {c.lower(): c for c in df.columns}
    out = []
    if bad_cells and BAD_CELLS in df.columns:
        keep = (*keep, BAD_CELLS)
    elif bad_cells:
        out.append(_bad_cells(df, schema).alias(BAD_CELLS))
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f"`{src}`").try_cast(f.dataType).alias(f.name))
    return df.select(*(out[1:] + out[:1] if bad_cells and len(out) > len(schema.fields) else out), *keep)


def _bad_cells(df: DataFrame, schema: StructType):
    """Map of column name to text for the row's cells that do not parse."""
    present = {c.lower(): c for c in df.columns}
    cells = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is not None and not isinstance(f.dataType, StringType):
            col = F.col(f"`{src}`")
            bad = col.isNotNull() & col.try_cast(f.dataType).isNull()
            cells.append(F.when(bad, F.struct(F.lit(f.name).alias("key"), col.cast("string").alias("value"))))
    if not cells:
        return F.lit(None).cast("map<string,string>")
    found = F.filter(F.array(*cells), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, F.map_from_entries(found))


def cast_rejects(raw: DataFrame, schema: StructType = LANDING) -> DataFrame:
    """Rows whose non-empty text did not parse into the declared type, with
    the offending column names in ``bad_columns``."""
    present = {c.lower(): c for c in raw.columns}
    checks = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None or isinstance(f.dataType, StringType):
            continue
        col = F.col(f"`{src}`")
        checks.append(F.when(col.isNotNull() & col.try_cast(f.dataType).isNull(), F.lit(f.name)))
    if not checks:
        return raw.where(F.lit(False)).withColumn("bad_columns", F.array().cast("array<string>"))
    bad_cols = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return raw.withColumn("bad_columns", bad_cols).where(F.size("bad_columns") > 0)


def drop_blank(df: DataFrame) -> DataFrame:
    """Drop rows in which every landing column is NULL (blank sheet lines)."""
    subset = [c for c in LANDING_COLUMNS if c in df.columns]
    return df.na.drop(how="all", subset=subset)


def landing_path(root: str) -> str:
    return f"{root.rstrip('/')}/landing"


def _batch_schema(*extra: StructField) -> StructType:
    return StructType([*LANDING.fields, BAD_CELLS_FIELD, StructField(BATCH_COL, DateType()), *extra])


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(name, is a directory)`` of what data readers see in a directory."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    found = [(st.getPath().getName(), st.isDirectory()) for st in fs.listStatus(p)]
    return sorted(c for c in found if c[0][0] not in "_.")


def _drop_parts(spark: SparkSession, root: str, day: date, part: str) -> None:
    """Remove what ``part`` of ``day`` held, also in the layouts of older releases."""
    for name, is_dir in _children(spark, f"{landing_path(root)}/{BATCH_COL}={day.isoformat()}"):
        old = not is_dir if part == LAND_PART else name == part.replace("-", "=")
        if old or name == f"{PART_COL}={part}":
            fs, p = hadoop_path(spark, f"{landing_path(root)}/{BATCH_COL}={day.isoformat()}/{name}")
            fs.delete(p, True)


def write_batches(df: DataFrame, root: str, days: list[date], part: str = LAND_PART) -> None:
    """Write one part of the batches of ``days`` (one job), replacing what it held before.
    ``df`` has the day of each row in ``batch_dt`` unless there is only one."""
    for day in days:
        _drop_parts(df.sparkSession, root, day, part)
    if len(days) == 1:
        (df.drop(BATCH_COL).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{landing_path(root)}/{BATCH_COL}={days[0].isoformat()}/{PART_COL}={part}"))
    elif days:
        df.withColumn(PART_COL, F.lit(part)).write.mode("append").partitionBy(BATCH_COL, PART_COL).parquet(landing_path(root))


def land(df: DataFrame, root: str, batch_dt: date | str) -> None:
    """Write one daily batch to the landing.

    A re-run, also with a smaller or an empty batch, replaces the batch; the commit
    is one Spark job. What a file stream landed for the day stays."""
    day = as_date(batch_dt)
    write_batches(drop_blank(conform(df, bad_cells=True)), root, [day])


def land_many(spark: SparkSession, files: dict[str, date | str], root: str,
              fmt: str = "parquet", **options: str) -> None:
    """Land several daily files (or folders of files) in one job. Each is read by
    its own column names and belongs to the day it was listed with; a listed path
    that does not exist fails the job."""
    missing = [p for p in files if not (found := hadoop_path(spark, p))[0].exists(found[1])]
    if missing:
        raise FileNotFoundError(f"not found: {missing}")
    parts = [read_daily(spark, p, fmt, bad_cells=True, **options).withColumn(BATCH_COL, F.lit(as_date(d))) for p, d in files.items()]
    rows = drop_blank(reduce(DataFrame.unionByName, parts))
    write_batches(rows, root, sorted({as_date(d) for d in files.values()}))


def _read_days(spark: SparkSession, root: str, days: list[str], place: bool) -> DataFrame:
    """Rows of the batches of ``days``: only their directories are listed, and
    directories of one layout are read together."""
    base, paths = landing_path(root), {PART_COL: [], "epoch": [], "": []}
    for day in days:
        at = f"{base}/{BATCH_COL}={day}"
        children = _children(spark, at)
        files = [f"{at}/{name}" for name, is_dir in children if not is_dir]
        paths[""] += files if len(files) < len(children) else [at] * bool(files)
        for kind in (PART_COL, "epoch"):
            paths[kind] += [f"{at}/{name}" for name, is_dir in children if is_dir and name.startswith(kind + "=")]
    parts = []
    for kind, own in paths.items():
        if own:
            schema = _batch_schema(*[StructField(kind, StringType())] * bool(kind))
            rows = spark.read.schema(schema).option("basePath", base).parquet(*own)
            where = [F.struct("_metadata.file_path", "_metadata.row_index").alias(PLACE)] * place
            parts.append(rows.select(*_batch_schema().fieldNames(), *where))
    if not parts:
        place_type = StructField(PLACE, StructType([StructField("file_path", StringType()), StructField("row_index", LongType())]))
        return spark.createDataFrame([], _batch_schema(*[place_type] * place))
    return reduce(DataFrame.unionByName, parts)


def landed_days(spark: SparkSession, root: str) -> list[str]:
    """Days with a batch, in order."""
    days = (name.split("=", 1)[1] for name, _ in _children(spark, landing_path(root)) if name.startswith(BATCH_COL + "="))
    return sorted(days)


def read_landing(spark: SparkSession, root: str, batch_dt: date | str | None = None, place: bool = False) -> DataFrame:
    """Landing rows, optionally of one batch (only that directory is listed).
    ``place`` adds where each row is stored."""
    return _read_days(spark, root, landed_days(spark, root) if batch_dt is None else [as_date(batch_dt).isoformat()], place)


def read_landing_range(spark: SparkSession, root: str, start: date | str, end: date | str, place: bool = False) -> DataFrame:
    """Landing rows of the batches from ``start`` to ``end``: only those
    partition directories are listed and read."""
    lo, hi = as_date(start).isoformat(), as_date(end).isoformat()
    return _read_days(spark, root, [d for d in landed_days(spark, root) if lo <= d <= hi], place)


def split_late(landing: DataFrame, d: date | str) -> tuple[DataFrame, DataFrame]:
    """Split a batch into rows of day ``d`` and the rest.

    The reference stages only the day's rows and then empties the whole
    landing table, losing the others; here they go to a quarantine frame with
    a ``reason`` (late / early / no_date)."""
    ts = F.col("date")
    lo, hi = day_start(d), day_end(d)
    on = landing.where((ts >= lo) & (ts < hi))
    reason = (F.when(ts.isNull(), F.lit("no_date"))
              .when(ts < lo, F.lit("late"))
              .otherwise(F.lit("early")))
    off = landing.where(ts.isNull() | (ts < lo) | (ts >= hi)).withColumn("reason", reason)
    return on, off


def row_problems(landing: DataFrame) -> DataFrame:
    """``problems``: what keeps (parts of) a row out of the warehouse. A NULL key or
    attribute keeps the row out of that dimension, which refuses NULLs; a row
    with bad cells is loaded with NULL in their place."""
    checks = []
    for name, spec in DIMS.items():
        key, *attrs = [spec.source[c] for c in spec.columns]
        hole = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in attrs])
        checks.append(F.when(F.col(f"`{key}`").isNull(), F.lit(f"null_key:{name}"))
                      .when(hole, F.lit(f"null_attribute:{name}")))
    from ..schemas import FACT_SOURCE
    fact = reduce(lambda a, b: a | b, [F.col(f"`{FACT_SOURCE[c]}`").isNull() for c in NOT_NULL["transactions"]])
    checks.append(F.when(fact, F.lit("null_column:transactions")))
    if BAD_CELLS in landing.columns:
        checks.append(F.when(F.col(BAD_CELLS).isNotNull(), F.lit("bad_cell")))
    return landing.withColumn("problems", F.filter(F.array(*checks), lambda x: x.isNotNull()))


def quarantined(on_day: DataFrame, off_day: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Rows that did not (fully) enter the warehouse, with their reasons. ``repeated`` holds
    the ``_place`` of the rows whose key an earlier operation has."""
    rows = row_problems(on_day)
    if repeated is not None:
        rows = rows.join(repeated.withColumn("_again", F.lit(True)), PLACE, "left").withColumn(
            "problems", F.when(F.col("_again"), F.concat("problems", F.array(F.lit("duplicate_key")))).otherwise(F.col("problems"))
        ).drop("_again")
    partial = rows.where(F.size("problems") > 0).withColumn("reason", F.array_join("problems", ",")).drop("problems")
    return off_day.unionByName(partial).drop(PLACE)

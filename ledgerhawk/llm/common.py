"""Helpers shared by the training-data operators.

* :func:`read` / :func:`keep` - input tables, and intermediate tables written as
  Parquet below the shared folder that ``spark.checkpoint.dir`` names.
* :func:`text_slices` - Arrow batches cut into slices of bounded text size, so a
  Python worker's memory does not depend on how long the documents are.
* :func:`prepared` - the input with only the asked columns, missing ones as NULL.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerhawk.config import checkpoint_dir

#: Text bytes a Python worker turns over at a time (a longer text is one slice).
SLICE_BYTES = 8 << 20
#: Bytes Spark sends a Python worker in one Arrow batch.
BATCH_BYTES = 16 << 20

DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, through Spark's own reader (any file system Spark knows)."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Bounded Arrow batches, and this package on every executor (Spark's own file
    server hands it out, also to executors that start later)."""
    bounded_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_lh_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = os.path.join(tempfile.mkdtemp(prefix="lh-package-"), "ledgerhawk_package.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(to)
    sc._lh_shipped = True


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes (long texts), unless the session's bound is lower already."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
                       ("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)):
        if not 0 < _number(spark.conf.get(key)) <= value:
            spark.conf.set(key, str(value))


def _number(setting: str) -> int:
    digits = setting.rstrip("bB")
    return int(digits) if digits.lstrip("-").isdigit() else -1


def prepared(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast to the given types; a missing one is NULL.
    Extra columns, whatever their names, never reach an operator."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def shared_folder(spark: SparkSession) -> str:
    """A new folder of this call below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Parquet looks at sizes after each of the first rows, not only from the 100th on.
LARGE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1",
              "parquet.page.size.row.check.min": "1"}


def keep(df: DataFrame, compression: str = "snappy", large_rows: bool = False) -> DataFrame:
    """``df`` written to a Parquet table in the shared folder and read back.

    ``large_rows``: rows have up to some MB, so row groups are small; Spark reads up to 4,096 rows of one at once.

    Cuts the lineage: later steps re-read the table, so a lost executor costs at
    most the tasks that ran on it, and nothing that feeds several steps is
    computed twice."""
    path = shared_folder(df.sparkSession)
    df.write.options(compression=compression, **(LARGE_ROWS if large_rows else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in order, cut so that a slice holds about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def text_groups(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Like :func:`text_slices`, but small batches are joined up to ``limit`` as well."""
    held, size = [], 0
    for part in text_slices(batches, column, limit):
        n = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if held and size + n > limit:
            yield _joined(held)
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield _joined(held)
    held = part = None
    pa.default_memory_pool().release_unused()  # an idle worker need not keep it beside the next step's heap


def release(*shared) -> None:
    """To call at a task's end, when nothing else refers to them: drops a Python worker's copies of broadcasts
    (its next task loads them again) and returns unused memory. Spark keeps idle workers, and
    with two Python steps in a stage there are two a core; each would keep what it used last."""
    for b in shared:
        if getattr(b, "_path", None) is not None:  # else (encrypted) there is no file to load it from again
            b.__dict__.pop("_value", None)
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def distinct_pieces(texts: pa.Array, lower=pc.ascii_lower) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Texts (null: empty) cut at ASCII white space: the code of every piece in order,
    the distinct pieces, and each text's offsets in the codes."""
    pieces = pc.ascii_split_whitespace(lower(pc.fill_null(texts.cast(pa.string()), "")))
    offsets = np.asarray(pieces.offsets, dtype=np.int64)
    values = pieces.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes = np.asarray(values.indices)
    return codes, values.dictionary.to_numpy(zero_copy_only=False).tolist(), offsets - offsets[0]


def doc_bucket(doc_id, n: int) -> int:
    """crc32 of the id as text, modulo ``n``: the fixed split into folds."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def fold(n: int, column: str = "doc_id"):
    """:func:`doc_bucket` as a Spark column (a NULL id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)

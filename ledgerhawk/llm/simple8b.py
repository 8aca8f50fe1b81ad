"""Token-id files in Simple-8b, read back by vectorised decoding.

Ids are packed into 64-bit words: the top four bits select how many ids of how
many bits the word's other 60 bits hold (``SELECTORS``). Selector 15 is an escape: the word then
holds the place of one wide id (over 60 bits) in the record's ``escapes``. Every
``BLOCK`` ids start a new word, whose place is in ``block_words``, so blocks can be
decoded alone; a block decodes by gathering and shifting, without a step per id.

A file set is written by Spark as Parquet, the container that every store Spark
knows can hold and whose commit protocol survives lost and repeated tasks. A
record holds whole documents in order: ``shard, record, doc_ids, sizes, n_ids,
words, block_words, escapes``. Shards are ranges of doc_id in ascending order
(NULL first; equal ids in the order of text hash and text), found by Spark's range
partitioning, so a global order needs no single task; a repeated doc_id may not
pile up either, as the text hash is part of the range key.

Defined cases: a NULL or empty text is the end id alone; repeated rows are
documents of their own; an empty table gives empty files; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, prepared, text_groups
from .subword import default_path, encoder, with_end

END_ID = 2
BLOCK = 4096
RECORD_IDS = 1 << 17
#: Fixed values: (ids per word, bits per id) of selectors 0, 1, 2, ...
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20),
             (2, 30), (1, 60))
ESCAPE = 15
_COUNTS = np.array([n for n, _ in SELECTORS] + [0, 1], dtype=np.int64)
_SHIFT = np.uint64(60)


def _widths(ids: np.ndarray) -> np.ndarray:
    """The first selector wide enough for each id; one more than the last for those that need an escape."""
    width = np.zeros(len(ids), dtype=np.uint8)
    for _, bits in SELECTORS[:-1]:
        width += ids >> np.uint64(bits) > 0
    width[ids >> _SHIFT > 0] = len(SELECTORS)
    return width


#: Of small ids, looked up.
_WIDTHS = _widths(np.arange(1 << 16, dtype=np.uint64))


def pack_words(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words uint64, first word of each block, escaped ids)`` of unsigned ids."""
    ids = np.asarray(ids, dtype=np.uint64)
    n = len(ids)
    wide = np.flatnonzero(ids >> _SHIFT)
    best = _best_selectors(ids, block)
    place = np.arange(n)
    end = np.minimum((place // block + 1) * block, n)  # a word never crosses its block
    steps = np.minimum(place + _COUNTS[best], end).tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at = steps[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = best[starts].astype(np.int64)
    words = chosen.astype(np.uint64) << _SHIFT
    for s in np.unique(chosen).tolist():
        where = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[where] |= np.searchsorted(wide, starts[where]).astype(np.uint64)
            continue
        count, bits = SELECTORS[s]
        slot = np.arange(count)
        at = starts[where][:, None] + slot
        inside = at < end[starts[where]][:, None]
        values = np.where(inside, ids[np.minimum(at, n - 1)], 0) << (slot * bits).astype(np.uint64)
        words[where] |= np.bitwise_or.reduce(values, axis=1)
    return words, np.searchsorted(starts, np.arange(0, n, block)), ids[wide]


def _best_selectors(ids: np.ndarray, block: int) -> np.ndarray:
    """For every place the selector that would hold most ids from there (to the block's end at most)."""
    n, pad = len(ids), SELECTORS[0][0]
    rows = -(-n // block)
    width = np.zeros(rows * block, dtype=np.uint8)  # bits of each id; nothing behind the last
    if ids.max(initial=0) < len(_WIDTHS):
        width[:n] = _WIDTHS.take(ids.astype(np.int64))
    else:
        width[:n] = _widths(ids)
    most = min(int(width.max(initial=0)), len(SELECTORS) - 1)
    # from here on every selector fits at every place without an escape
    best = np.where(width < len(SELECTORS), most, ESCAPE).astype(np.uint8).reshape(rows, block)
    fits = np.ones((rows, block + pad), dtype=bool)
    for s in range(most - (width.max(initial=0) <= most), -1, -1):
        count = SELECTORS[s][0]
        np.less_equal(width.reshape(rows, block), s, out=fits[:, :block])
        run, size = fits, 1
        while 2 * size <= count:  # run[i]: the next `size` ids fit
            run, size = run[:, :-size] & run[:, size:], 2 * size
        np.copyto(best, np.uint8(s), where=run[:, :block] & run[:, count - size:count - size + block])
    return best.reshape(-1)[:n]


def unpack_words(words: np.ndarray, block_words: np.ndarray, escapes: np.ndarray, n_ids: int,
                 block: int = BLOCK) -> np.ndarray:
    """The ids of consecutive blocks (all of a record's, or ``words`` of some with their count)."""
    if not n_ids:
        return np.zeros(0, dtype=np.uint64)
    words = np.asarray(words, dtype=np.uint64)
    selectors = (words >> _SHIFT).astype(np.int64)
    counts = _COUNTS[selectors].copy()
    ends = np.append(block_words[1:], len(words)).astype(np.int64)
    sizes = np.minimum(block, n_ids - block * np.arange(len(block_words)))
    total = np.add.reduceat(counts, block_words)
    counts[ends - 1] -= total - sizes  # a block's last word may have unused places
    starts = np.cumsum(counts) - counts
    out = np.empty(n_ids, dtype=np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(selectors).tolist():
        where = np.flatnonzero(selectors == s)
        if s == ESCAPE:
            out[starts[where]] = escapes[payload[where].astype(np.int64)]
            continue
        count, bits = SELECTORS[s]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            there = where[counts[where] > k]
            out[starts[there] + k] = (payload[there] >> np.uint64(k * bits)) & mask
    return out


RECORD = ("shard int, record int, doc_ids array<long>, sizes array<long>, n_ids long, words binary, "
          "block_words array<int>, escapes binary")


def write_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
                record_ids: int = RECORD_IDS) -> None:
    """All documents' ids, in ascending doc_id order, as a file set at ``path``."""
    vocabulary = vocabulary or default_path()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, number = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in text_groups(batches):
            ids, bounds = with_end(*enc.encode(batch.column("text")), end_id)
            doc_ids = batch.column("doc_id").to_pylist()
            first = 0
            while first < len(doc_ids):  # whole documents, about record_ids ids, at least one
                last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + record_ids, side="right")) - 1)
                last = min(last, len(doc_ids))
                words, block_words, escapes = pack_words(ids[bounds[first]:bounds[last]])
                yield pa.RecordBatch.from_pylist([{
                    "shard": shard, "record": number, "doc_ids": doc_ids[first:last],
                    "sizes": np.diff(bounds[first:last + 1]), "n_ids": int(bounds[last] - bounds[first]),
                    "words": words.astype("<u8").tobytes(), "block_words": block_words,
                    "escapes": escapes.astype("<u8").tobytes()}], schema=_RECORD)
                first, number = last, number + 1

    ordered = prepared(docs, doc_id="bigint", text="string").withColumn("hash", F.xxhash64("text")) \
        .repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    ordered.select("doc_id", "text").mapInArrow(records, RECORD).write.parquet(path)


_RECORD = pa.schema([("shard", pa.int32()), ("record", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                     ("sizes", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("words", pa.binary()),
                     ("block_words", pa.list_(pa.int32())), ("escapes", pa.binary())])


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The records of a file set with ``start``: the ids of all documents before the record."""
    from pyspark.sql import types as T

    files = spark.read.schema(T.StructType.fromDDL(RECORD)).parquet(path)
    sizes = files.groupBy("shard").agg(F.sum("n_ids").alias("size"), F.max("record").alias("last"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", "record", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside")) \
        .join(shards, "shard").select("shard", "record", (F.col("base") + F.col("inside")).alias("start"))
    return files.join(keep(starts), ["shard", "record"])  # a table of known size: the words need not move to meet it


def record_ids(row: dict) -> np.ndarray:
    """All ids of one record, decoded."""
    return unpack_words(np.frombuffer(row["words"], dtype="<u8"), np.asarray(row["block_words"], dtype=np.int64),
                        np.frombuffer(row["escapes"], dtype="<u8"), row["n_ids"])


DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def documents(records: DataFrame) -> DataFrame:
    """Per document of :func:`read_files`: place, length and crc32 of the decoded ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = memoryview(record_ids(row).astype("<u4").tobytes())
                bounds = np.concatenate(([0], np.cumsum(row["sizes"])))
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + bounds[:-1], pa.int64()),
                     pa.array(row["sizes"], pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return records.mapInArrow(run, DOCUMENT)

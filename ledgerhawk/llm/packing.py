"""Sequence packing: first-fit decreasing on a tournament tree, in random groups.

Each document's ids (with an end id) are cut into full sequences of ``capacity``
ids plus a rest. Documents are dealt at random into groups of about
``group_docs``; each group is packed on its own by first-fit decreasing: pieces
by falling length, each into the first bin with room, found by descending a
tournament tree whose nodes hold the largest room below them. Only the pieces'
sizes are shuffled, never texts or ids, and a group's size does not depend on
the size of the corpus or on any key of the data.

Defined cases: a NULL or empty text is the end id alone; repeated rows and
repeated or NULL doc_ids are packed as documents of their own; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepared, text_groups
from .subword import default_path, encoder, with_end

CAPACITY = 2048
GROUP_DOCS = 4000
END_ID = 1
_BIN_BITS = 26

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, grp long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; ``lengths`` must be falling and at most ``capacity``."""
    n = len(lengths)
    size = 1
    while size < max(n, 1):
        size *= 2
    room = [capacity] * (2 * size)
    bins, offsets = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for i, need in enumerate(lengths.tolist()):
        node = 1
        while node < size:  # the left child wins whenever it has room
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - size, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def cut_pieces(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: full sequences, then the rest."""
    return [(s, min(capacity, n_ids - s)) for s in range(0, n_ids, capacity)]


def document_pieces(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID,
                    capacity: int = CAPACITY, groups: int = 1, seed: int = 7) -> DataFrame:
    """One row per piece with its crc32 and the random group of its document."""
    vocabulary = vocabulary or default_path()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        # the row's place in its task deals the groups: no key of the data can make one large
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in text_groups(batches):
            ids, bounds = with_end(*enc.encode(batch.column("text")), end_id)
            raw, out = memoryview(ids.tobytes()), []
            grp = rng.integers(0, groups, batch.num_rows).tolist()
            for d, g, a, b in zip(batch.column("doc_id").to_pylist(), grp, bounds.tolist(), bounds[1:].tolist(),
                                  strict=False):
                out += [(d, s, n, zlib.crc32(raw[4 * (a + s):4 * (a + s + n)]), b - a, g)
                        for s, n in cut_pieces(b - a, capacity)]
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grp"])

    return prepared(docs, doc_id="bigint", text="string").mapInArrow(pieces, PIECES)


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
         group_docs: int = GROUP_DOCS, seed: int = 7) -> DataFrame:
    """All documents' pieces with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence)."""
    groups = max(1, -(-docs.count() // group_docs))
    pieces = document_pieces(docs, vocabulary, end_id, capacity, groups, seed)

    def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True],
                              kind="stable")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=(pdf["grp"].to_numpy() << _BIN_BITS) + bins, offset=offsets).drop(columns="grp")

    return pieces.groupBy("grp").applyInPandas(pack_group, PACKED)


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Report: sequences, ids, padded ids (a sequence of a power of two of ids stays unpadded)."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    whole = F.shiftright(F.lit(1).cast("bigint"), 0)
    power = F.col("used").bitwiseAND(F.col("used") - whole) == 0
    return used.agg(F.count(F.lit(1)).alias("sequences"), F.coalesce(F.sum("used"), F.lit(0)).alias("ids"),
                    F.coalesce(F.sum(F.when(power, 0).otherwise(capacity - F.col("used"))), F.lit(0)).alias("padded"))

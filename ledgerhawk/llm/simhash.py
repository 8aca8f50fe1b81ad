"""SimHash near-duplicates: fingerprints, pigeonhole block join, components.

1. Fingerprint: a bit is 1 if set in over half the XXH64 hashes of the text's
   word shingles (whole text, repeats count).
2. Pigeonhole: the 64 bits are cut into ``max_bits + 3`` blocks. Two
   fingerprints at ``max_bits`` or fewer differing bits agree on at least 3 of
   them, so they meet under one of the C(blocks, 3) keys made of 3 blocks. Only
   distinct fingerprints are joined: copies never multiply.
3. Verify: members of a key are compared with XOR and a bit count. A key with
   more than ``chunk`` fingerprints is dealt into chunks, and every pair of
   chunks is compared as one bounded group, so nothing is dropped and no group
   is unbounded. A group returns a spanning forest of its links, never all pairs.
4. Components: alternating large-star / small-star rounds over written tables
   until nothing changes.

Joins straight on written or exploded tables that grow with the corpus are sort-merge
joins by hint: Spark sizes the first by their compressed files and the others like their
source, so it would broadcast far more than ``autoBroadcastJoinThreshold``. Elsewhere
a side is a shuffle, whose size Spark knows before it decides.

Defined cases: NULL, empty and blank texts have fingerprint zero and are linked
like any other; repeated rows and doc_ids keep one row each; NULL doc_ids never
name a component (a component of NULLs only has a NULL id); an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, prepared, text_slices

SHINGLE = 4
MAX_BITS = 4
CHUNK = 1024
_SHARED_BLOCKS = 3


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text (0 without words)."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, 42)]
    else:
        ends = list(accumulate([len(w) + 1 for w in words]))
        hashes = [xxh64_intdigest(joined[a:b - 1], 42) for a, b in zip([0, *ends], ends[shingle - 1:], strict=False)]
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[k:k + (1 << 14)], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(docs: DataFrame, column: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """All columns of ``docs`` and the fingerprint (as a signed long)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            fps = [_signed(fingerprint(t, shingle)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())],
                                             [*batch.schema.names, column])

    return docs.mapInArrow(add, schema)


def block_masks(max_bits: int = MAX_BITS) -> list[int]:
    """One mask per combination of blocks that a close pair may share."""
    blocks = max_bits + _SHARED_BLOCKS
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(parts, _SHARED_BLOCKS)]


def _forest(fps: list[int], max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints: (larger, smaller) edges."""
    if len(fps) == 2:
        a, b = sorted(fps)
        return [(b, a)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= max_bits else []
    left = np.array(sorted(set(fps)), dtype=np.int64)
    bits = left.view(np.uint64)
    edges, todo = [], np.ones(len(left), dtype=bool)
    for seed in range(len(left)):  # breadth first: every fingerprint is compared once, with those not yet reached
        if not todo[seed]:
            continue
        todo[seed], front = False, [seed]
        while front:
            at = front.pop()
            rest = np.flatnonzero(todo)
            near = rest[np.bitwise_count(bits[rest] ^ bits[at]) <= max_bits]
            todo[near] = False
            front += near.tolist()
            edges += [(max(x, int(left[at])), min(x, int(left[at]))) for x in left[near].tolist()]
    return edges


def links(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """``(a, b)``, a > b: verified links that connect all fingerprints (distinct, column
    ``fp``) at ``max_bits`` or fewer differing bits."""
    masks = block_masks(max_bits)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("part", "mask")) \
        .select("fp", "part", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = keyed.join(sizes.hint("merge"), ["part", "key"]) \
        .withColumn("chunks", F.ceil(F.col("n") / F.lit(chunk)).cast("int")) \
        .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    groups = dealt.groupBy("part", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")) \
        .agg(F.collect_list("fp").alias("fps"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {e for members in batch.column("fps").to_pylist() for e in _forest(members, max_bits)}
            a, b = (list(x) for x in zip(*found, strict=True)) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return groups.select("fps").mapInArrow(verify, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the component's
    smallest node and has no row of its own. Each round is written to the shared folder."""
    now, before = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        now = keep(large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m")), F.struct(F.col("a").alias("x"), F.col("m"))))
        ).select(F.col("col.x").alias("a"), F.col("col.m").alias("b")).where("a > b").distinct())
    raise RuntimeError("the components did not settle")


def component_map(ids: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """``(fp, root, component_id)`` per distinct fingerprint of ``ids (doc_id, fp)``."""
    per_fp = keep(ids.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(per_fp.select("fp"), max_bits, chunk))
    rooted = per_fp.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left") \
        .select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    ids = keep(with_fingerprint(prepared(docs, doc_id="bigint", text="string"), "fp", shingle).drop("text"))
    return ids.join(component_map(ids, max_bits).hint("merge"), "fp").select("doc_id", "fp", "component_id")


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_component(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each component the document
    with the smallest doc_id (NULL ids only if there is no other); of several rows
    with that id the first in the order of text and fingerprint."""
    ids = keep(with_fingerprint(prepared(docs, doc_id="bigint", text="string"), "fp", shingle).drop("text"))
    fp, root, best = "__lh_fp", "__lh_root", "__lh_best"
    chosen = component_map(ids, max_bits).toDF(fp, root, best)
    named = with_fingerprint(docs, fp, shingle).join(chosen.hint("merge"), fp) \
        .where(F.col("doc_id").cast("bigint").eqNullSafe(F.col(best)))
    from pyspark.sql import Window

    order = Window.partitionBy(root).orderBy("text", fp)
    return named.withColumn("__lh_n", F.row_number().over(order)).where("__lh_n = 1").select(*docs.columns)

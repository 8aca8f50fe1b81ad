"""Byte-level BPE over overlapping chunks, and decoding.

A long text is cut into chunks of ``CHUNK`` characters that overlap by
``OVERLAP``. Every chunk is pre-tokenised on its own, from its first character,
in parallel. The pattern looks only forward, so once two scans of the same text
share a boundary they agree from there on: chunks are stitched at the first
boundary in the overlap that both have and that the earlier chunk's end cannot
have disturbed. Where an overlap holds none (one pre-token longer than the
overlap), the earlier scan goes on over the later chunk's text instead. The
stitched pieces are then encoded by the ranks, each on its own; a bounded memo
only saves encoding a piece twice. Decoding gathers each id's raw bytes.

Ids travel as packed little-endian unsigned 32-bit integers (``ids`` binary).

Defined cases: NULL counts as the empty text, without ids; repeated rows are
encoded alike; one row comes back for every input row, in no order; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepared, text_groups

CHUNK, OVERLAP = 32_768, 1_024
MEMO_PIECES = 800_000
#: A boundary this near to a chunk's end may depend on the characters behind it (longest contraction, and one more).
_MARGIN = 4


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteBpe:
    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        import regex
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.core = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.pattern = regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                     .replace(r"\S", r"\P{White_Space}"))
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.raw = _Gather(tokens)
        self.decimal = _Gather([b"%d " % i for i in range(size)])
        self.memo: dict[str, bytes] = {}
        self.memo_pieces = memo_pieces

    def scan(self, text: str) -> list[str]:
        """Pre-tokens of a text, from its first character."""
        return self.pattern.findall(text)

    def encode_pieces(self, pieces: list[str]) -> bytes:
        memo = self.memo
        if len(memo) > self.memo_pieces:
            memo.clear()
        out = list(map(memo.get, pieces))
        if None in out:
            for i, b in enumerate(out):
                if b is None:
                    piece = pieces[i]
                    if (b := memo.get(piece)) is None:
                        ids = self.core.encode_single_piece(piece.encode("utf-8", "replace"))
                        b = array("I", ids).tobytes()
                        if len(piece) <= 64:
                            memo[piece] = b
                    out[i] = b
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The raw bytes of packed ids, one after the other."""
        return self.raw.join(np.frombuffer(ids, dtype="<u4"))


class _Gather:
    """Concatenates table entries by index, without a Python step per entry."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), dtype=np.uint8)
        self.sizes = np.array(list(map(len, entries)), dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, index: np.ndarray) -> bytes:
        parts = []
        for k in range(0, len(index), 1 << 18):
            at = index[k:k + (1 << 18)]
            sizes = self.sizes[at]
            shift = self.starts[at] - (np.cumsum(sizes) - sizes)
            parts.append(self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes())
        return b"".join(parts)


@lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    return ByteBpe(path)


def chunk_ends(bpe: ByteBpe, chunk: str) -> list[int]:
    """Ends of a chunk's pre-tokens, counted in the chunk."""
    return np.cumsum([len(p) for p in bpe.scan(chunk)], dtype=np.int64).tolist()


def stitch(bpe: ByteBpe, chunks: list[str], ends: list[list[int]], step: int) -> list[str]:
    """Pre-tokens of the whole text from its overlapping chunks (each ``step`` after the one before)."""
    pieces: list[str] = []
    text, base, bounds = chunks[0], 0, [0, *ends[0]]  # bounds: starts and last end in `text`, which begins at `base`
    for k in range(1, len(chunks)):
        start = k * step
        later = {start, *(start + e for e in ends[k])}
        sure = [b for b in bounds if b <= len(text) - _MARGIN]
        joined = text + chunks[k][base + len(text) - start:]
        meet = next((b for b in sure if base + b in later and base + b >= start), None)
        if meet is None:  # scan on from the last sure boundary, in place of the later chunk's scan
            meet = sure[-1] if sure else 0
            after = [m.end() for m in bpe.pattern.finditer(joined, meet)]
        else:
            after = [start + e - base for e in ends[k] if start + e - base > meet]
        done = [b for b in sure if b <= meet]
        pieces += [text[a:b] for a, b in zip(done, done[1:], strict=False)]
        text, base, bounds = joined[meet:], base + meet, [0, *(e - meet for e in after)]
    return pieces + [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


IDS = "doc_id long, ids binary"


def encode(docs: DataFrame, ranks: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids`` of every row."""
    ranks = ranks or default_path()
    docs = prepared(docs, doc_id="bigint", text="string")
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk + overlap

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in text_groups(batches):
            ids = [bpe.encode_pieces(bpe.scan(t)) if t else b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in text_groups(batches):
            ends = [chunk_ends(bpe, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "ends"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in batches:
            for d, parts in zip(batch.column("doc_id"), batch.column("parts"), strict=True):
                parts = sorted(parts.as_py(), key=lambda p: p["k"])
                pieces = stitch(bpe, [p["text"] for p in parts], [p["ends"] for p in parts], chunk)
                ids = pa.array([bpe.encode_pieces(pieces)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([d.as_py()], pa.int64()), ids], ["doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                starts = range(0, max(len(text) - overlap, 1), chunk)
                for first in range(0, len(starts), 64):
                    some = starts[first:first + 64]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([batch.column(c)[i].as_py()] * len(some), pa.int64()) for c in ("row", "doc_id")),
                         pa.array(range(first, first + len(some)), pa.int32()),
                         pa.array([text[a:a + chunk + overlap] for a in some], pa.string())],
                        ["row", "doc_id", "k", "text"])

    # Cut where the text lies: a chunk costs its own length, not a walk from the text's start.
    chunks = docs.where(long).withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text") \
        .mapInArrow(cut, "row long, doc_id long, k int, text string").repartition("row", "k")
    scanned = chunks.mapInArrow(scan, "row long, doc_id long, k int, text string, ends array<int>")
    texts = scanned.groupBy("row", "doc_id").agg(F.collect_list(F.struct("k", "text", "ends")).alias("parts"))
    return docs.where(~long).mapInArrow(whole, IDS).unionByName(texts.select("doc_id", "parts").mapInArrow(join, IDS))


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, data``: the bytes of every row of ``encode``'s result."""
    ranks = ranks or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in batches:
            data = [bpe.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """Counts and digests of ``encode``'s rows; the decoded digest is of the decoded ids."""
    ranks = ranks or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            spelt = [hashlib.sha256(bpe.decimal.join(np.frombuffer(x, dtype="<u4"))[:-1]).hexdigest() for x in rows]
            back = [hashlib.sha256(bpe.decode(x)).hexdigest() for x in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in rows], pa.int64()),
                 pa.array(spelt, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

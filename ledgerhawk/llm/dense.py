"""Dense vectors summed over tasks, and a minimal perfect hash to index them.

* :func:`tree_sum` - ``(segment, part, vec)`` rows, one dense vector a task and
  segment, added up level by level. A task streams its rows sorted by segment, so it
  holds one vector of ``SEGMENT`` numbers at a time, however many there are.
* :class:`Mph` - minimal perfect hash of a key set, dealt into segments of about
  ``SEGMENT`` keys. Inside a segment a key takes a bit of its own in the first of
  several bit arrays in which no other key hashes to its place; its slot is that bit's rank.
  The keys are kept in slot order, so that a key outside the set is told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Expected keys of a segment, and numbers of one dense vector.
SEGMENT = 1 << 16
#: Vectors that one task of a level adds up, about.
FAN = 32

_DDL = "segment int, part int, vec binary"


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (splitmix64) of unsigned numbers."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting (numpy's own way is much slower on large arrays)."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def vectors(part: int, vecs: dict[int, np.ndarray]) -> pa.RecordBatch:
    """One task's vectors as rows for :func:`tree_sum`."""
    return pa.RecordBatch.from_arrays(
        [pa.array(list(vecs), pa.int32()), pa.array([part] * len(vecs), pa.int32()),
         pa.array([v.astype("<i8").tobytes() for v in vecs.values()], pa.binary())], ["segment", "part", "vec"])


def _add_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, part, total = None, 0, None
    for batch in batches:
        for segment, p, vec in zip(*(batch.column(c).to_pylist() for c in ("segment", "part", "vec")), strict=True):
            one = np.frombuffer(vec, dtype="<i8")
            if (segment, p) != now:
                if now is not None:
                    yield vectors(now[1], {now[0]: total})
                now, total = (segment, p), one.copy()
            else:
                total += one
    if now is not None:
        yield vectors(now[1], {now[0]: total})


def tree_sum(rows: DataFrame, parts: int, then=None, ddl: str = "") -> DataFrame:
    """``(segment, vec)``: the sum of each segment's vectors over all ``parts`` tasks. Or what ``then``, a function
    for mapInArrow, makes of them (rows of ``ddl``): in one Python step, since with a second one Spark keeps two workers a core."""
    def add_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(_add_sorted(batches))

    summed = False
    while parts > 1:
        parts = -(-parts // FAN)
        summed = parts == 1
        rows = rows.select("segment", F.pmod("part", F.lit(parts)).alias("part"), "vec") \
            .repartition("segment", "part").sortWithinPartitions("segment", "part") \
            .mapInArrow(*((add_last, ddl) if summed and then else (_add_sorted, _DDL)))
    if then:
        return rows if summed else rows.mapInArrow(then, ddl)
    return rows.select("segment", "vec")


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(keys, 77) >> np.uint64(1)).astype(np.int64) % segments


def build_segment(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """``(bits per level, bit words, keys in slot order)`` of distinct unsigned keys."""
    sizes, words, left = [], [], keys
    while len(left):
        size = -(-len(left) // 64) * 64
        at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, dtype=np.uint8)
        bits[at[alone]] = 1
        sizes.append(size)
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        left = left[~alone]
    flat = np.concatenate(words) if words else np.zeros(0, dtype="<u8")
    table = np.zeros(len(keys), dtype=keys.dtype)
    if len(keys):
        one = Mph(1, [0], [sizes], [flat], [table])
        table[one.slots(keys, verify=False)] = keys
    return sizes, flat, table


class Mph:
    """Segments ``of`` out of ``segments``; :meth:`slots` gives numbers 0 to n - 1 (-1: not a key of these segments)."""

    def __init__(self, segments: int, of: list[int], sizes: list[list[int]], words: list[np.ndarray],
                 keys: list[np.ndarray]):
        self.segments = segments
        self.at = np.full(segments, -1, dtype=np.int64)
        self.at[np.asarray(of, dtype=np.int64)] = np.arange(len(of))
        depth = max([len(s) for s in sizes], default=0)
        self.size = np.zeros((len(of), depth), dtype=np.int64)
        for i, s in enumerate(sizes):
            self.size[i, :len(s)] = s
        first = np.cumsum([0] + [64 * len(w) for w in words])[:-1]
        self.start = np.cumsum(np.concatenate([np.zeros((len(of), 1), dtype=np.int64), self.size], axis=1), axis=1)[:, :-1] \
            + np.asarray(first, dtype=np.int64).reshape(-1, 1)
        self.words = np.concatenate(words).astype(np.uint64) if words else np.zeros(0, dtype=np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint32)
        #: First slot of each of the segments.
        self.base = np.cumsum([0] + [len(k) for k in keys])

    def slots(self, keys: np.ndarray, verify: bool = True) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        mine = self.at[segment_of(keys, self.segments)]
        todo = todo[mine >= 0]
        for level in range(self.size.shape[1]):
            if not len(todo):
                break
            row = mine[todo]
            size = self.size[row, level]
            todo, row, size = todo[size > 0], row[size > 0], size[size > 0]
            bit = (mixed(keys[todo], level) % size.astype(np.uint64)).astype(np.int64) + self.start[row, level]
            word, low = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> low) & np.uint64(1) == 1
            under = word[hit] & ((np.uint64(1) << low[hit]) - np.uint64(1))
            out[todo[hit]] = self.before[bit[hit] >> 6] + np.bitwise_count(under)
            todo = todo[~hit]
        if verify and len(self.keys):
            found = out >= 0
            wrong = found.copy()
            wrong[found] = self.keys[out[found]] != keys[found]
            out[wrong] = -1
        return out

"""Language-model scores: a causal self-attention model over subword ids.

The ids of the whole text (an end id closes it) are predicted one after the other:

    log p(id | context) = log p(class | context) + log p(id | class, class before)

Classes are ``CLASSES`` groups of ids: the most frequent ones alone, the rest in bins of
equal training mass. One layer of causal self-attention in numpy predicts the class:

    z = log p(class | id before) + attention(ids before) @ out

in two choices, the class's group (of 16) and the class in its group, so that a
symbol costs two small softmaxes. The conditional counts come from all training
documents; query, key, value, position and output parameters are learned by
gradient steps. Every id seen in training has a query, key and value of its own; the
others share their class's, the mean of its ids. All tables are bounded by ids seen x classes. Windows of
``2 * HOP`` symbols overlap by half: the first half is context only, so every
symbol is scored once, from HOP to 2 * HOP - 1 symbols of context, in batches
with a causal mask.

Training is data parallel: each task runs Adam over its own windows from common
parameters, and Spark averages the results, ``ROUNDS`` times. The rounds share the
windows out: every window of every training document takes one gradient step. A step
touches the rows of its own ids only, and a row's average is weighted by its steps.

The base score is a word unigram over the counts of all training words. Texts are
written once as blocks of bounded size with each block's distinct words, in slices by a
hash of the word; counts meet the blocks by a shuffle on slices, where a word has one
entry per block however often it occurs, and come back per block. Nothing of the
vocabulary's size is broadcast or collected.

Defined cases: a NULL or empty text is its end token alone; repeated rows count
as often as they occur and are scored alike; a NULL doc_id falls in the fold of
the empty text; without training documents counts are zero and classes equally
likely; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import distinct_pieces, fold, keep, prepared, text_groups
from .subword import default_path, encoder

CLASSES, WIDTH, HOP = 256, 16, 16
ROUNDS, BATCH, RATE = 2, 64, 0.01
ALPHA = 0.1
#: Weight of the class before against the id before, and of the class alone against the class before.
BACK_ID, BACK_CLASS = 20.0, 5.0
BLOCK_BYTES = 14 << 20
#: Slices of a block's words, by hash, and words of all blocks that are counted together (a slice at least).
SLICES, PART_WORDS = 4096, 250_000
#: Places of one class group multiplied together, and occurrences of a row summed side by side, in a gradient step.
#: Batches whose windows are laid out together.
CHUNK, TURNS, TOGETHER = 16, 16, 32
_NEVER = np.float32(-1e9)


def held_out() -> Column:
    """The fold that is never learned from."""
    return fold(10) == 0


# ---------------------------------------------------------------- blocks and counts

def packed(codes: np.ndarray) -> bytes:
    """Codes as four planes of bytes, lowest first: the upper ones are nearly constant, so they take little
    room where Spark compresses them (tables, shuffles)."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


_BLOCKS = "block long, row int, doc_id long, words binary, ids binary, code int, word string, n long"
_SLICED = "block long, row int, doc_id long, words binary, ids binary, slice int, size int, spelled string, codes binary, n binary"


def blocks(docs: DataFrame, vocabulary: str, slices: int = 0) -> DataFrame:
    """Texts in blocks of about ``BLOCK_BYTES``, as two kinds of rows.

    One per text (``row``): its words as codes of its block (:func:`packed`) and its subword ids,
    packed (uint16). One per distinct word of a block (``code``): how often it occurs in
    the block's training documents (column ``train``). With ``slices``, one per ``slice`` of a block's
    words instead, by a hash of the word: the words (line by line), their codes and counts (uint32), ``size`` of each."""
    schema = _SLICED if slices else _BLOCKS
    names = [c.split()[0] for c in schema.split(", ")]
    types = [_TYPES[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        first = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(text_groups(batches, limit=BLOCK_BYTES)):
            codes, words, offsets = distinct_pieces(batch.column("text"))
            train = np.repeat(batch.column("train").to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets))
            n = np.bincount(codes[train], minlength=len(words))
            blank = np.array([w == "" for w in words], dtype=bool)  # around leading and trailing white space
            at = np.flatnonzero(~blank)
            ids, bounds = enc.encode_pieces(codes, words, offsets)
            codes, ids = codes.astype("<u4"), ids.astype("<u2")
            own, mine = [], []
            for a, b, c, d in zip(offsets, offsets[1:], bounds, bounds[1:], strict=False):
                own.append(packed(codes[a:b][~blank[codes[a:b]]]))
                mine.append(ids[c:d].tobytes())
            spelled, n = pa.array([words[i] for i in at], pa.string()), n[at]
            for kind in ({"row": pa.array(range(batch.num_rows), pa.int32()), "doc_id": batch.column("doc_id"),
                          "words": pa.array(own, pa.binary()), "ids": pa.array(mine, pa.binary())},
                         _sliced(spelled, at, n, slices) if slices else
                         {"code": pa.array(at, pa.int32()), "word": spelled, "n": pa.array(n, pa.int64())}):
                size = len(next(iter(kind.values())))
                kind["block"] = pa.array(np.full(size, first + k), pa.int64())
                columns = [kind.get(c, pa.nulls(size, t)) for c, t in zip(names, types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _sliced(spelled: pa.Array, codes: np.ndarray, n: np.ndarray, slices: int) -> dict[str, pa.Array]:
    """A block's words as one row per slice that has any."""
    if not len(spelled):
        return {c: pa.array([], _TYPES[t]) for c, t in (x.split() for x in _SLICED.split(", ")[5:])}
    of = (pd.util.hash_array(spelled.to_numpy(zero_copy_only=False), categorize=False) % slices).astype(np.int64)
    order = np.argsort(of.astype(np.uint16) if slices <= 1 << 16 else of, kind="stable")
    of = of[order]
    bounds = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of))
    words = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spelled.take(pa.array(order)))
    return {"slice": pa.array(of[bounds[:-1]], pa.int32()), "size": pa.array(np.diff(bounds), pa.int32()),
            "spelled": pc.binary_join(words, "\n"),  # no word has a line break
            "codes": _cut(codes[order].astype("<u4"), bounds), "n": _cut(n[order].astype("<u4"), bounds)}


def _cut(x: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers between bounds, as binary values."""
    at = pa.py_buffer((bounds * x.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(x))])


def _count(part: pa.Table) -> pa.Table:
    """Slices of some blocks, with all rows of every word in them: per block its words' codes (uint32) and
    their counts over all blocks (int64); the first row also has all words' occurrences ``n`` and how many words have one."""
    words = pc.split_pattern(part["spelled"].combine_chunks(), "\n").flatten().dictionary_encode()
    which = np.asarray(words.indices)
    n, codes = (np.frombuffer(b"".join(part[c].to_pylist()), dtype="<u4") for c in ("n", "codes"))
    total = np.zeros(len(words.dictionary), dtype=np.int64)
    np.add.at(total, which, n.astype(np.int64))
    block = np.repeat(part["block"].to_numpy(), part["size"].to_numpy())
    order = np.argsort(block, kind="stable")
    block = block[order]
    bounds = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
    once = np.zeros((2, len(bounds) - 1), dtype=np.int64)
    once[:, 0] = total.sum(), (total > 0).sum()
    return pa.table({"block": block[bounds[:-1]], "codes": _cut(codes[order], bounds),
                     "c": _cut(total[which[order]].astype("<i8"), bounds), "n": once[0], "v": once[1]})


# ---------------------------------------------------------------- the model

@dataclass
class Tables:
    """Counts of the training ids; the last id is the end, which also stands before every text."""

    of: np.ndarray  # class of each id
    row: np.ndarray  # row of each id in `skip`: its own if seen in training, else its class's
    column: np.ndarray  # column of each id in `pairs`; the last for all unseen ids
    share: np.ndarray  # p(id | class)
    skip: np.ndarray  # p(class | id before)
    pairs: np.ndarray  # counts of (class before, id)
    pair_totals: np.ndarray  # counts of (class before, class)
    seen: int  # ids seen in training

    @classmethod
    def of_ids(cls, counts: np.ndarray, n: int = CLASSES) -> Tables:
        """Classes from the ids' counts; the conditional tables are filled by :meth:`fill`."""
        order = np.argsort(-counts, kind="stable")
        mass = counts[order] + ALPHA
        alone = n // 2
        of = np.empty(len(counts), dtype=np.int64)
        of[order[:alone]] = np.arange(alone)
        before = np.cumsum(mass[alone:]) - mass[alone:]
        of[order[alone:]] = alone + np.minimum(before / mass[alone:].sum() * (n - alone), n - alone - 1).astype(int)
        seen = np.flatnonzero(counts)
        rank = np.full(len(counts), len(seen))
        rank[seen] = np.arange(len(seen))
        share = (counts + ALPHA) / np.bincount(of, counts + ALPHA, n)[of]
        row = np.where(rank < len(seen), rank, len(seen) + of)
        return cls(of, row, rank, share, np.zeros((0, n)), np.zeros((n, 0)), np.zeros((n, n)), len(seen))

    def fill(self, next_class: np.ndarray, next_id: np.ndarray) -> Tables:
        """``next_class``: counts of (seen id, class after); ``next_id``: of (class, column of the id after)."""
        n = len(self.pair_totals)
        first = np.zeros(len(next_class), dtype=np.int64)
        known = np.flatnonzero(self.row < len(next_class))
        first[self.row[known]] = self.of[known]
        by_class = np.zeros((n, n))
        np.add.at(by_class, first, next_class)
        by_class = (by_class + 0.5) / (by_class + 0.5).sum(axis=1, keepdims=True)
        own = (next_class + BACK_ID * by_class[first]) / (next_class.sum(axis=1, keepdims=True) + BACK_ID)
        self.skip = np.concatenate((own, by_class)).astype(np.float32)
        self.pairs = next_id.astype(np.float32)
        column_class = np.zeros(next_id.shape[1], dtype=np.int64)
        column_class[self.column[known]] = self.of[known]
        self.pair_totals = np.stack([np.bincount(column_class, r, n) for r in next_id])
        return self

    def within(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """p(id | class, class before)."""
        hits = self.pairs.reshape(-1).take(before * self.pairs.shape[1] + self.column.take(ids)).astype(float)
        hits += BACK_CLASS * self.share.take(ids)
        hits /= self.pair_totals.reshape(-1).take(before * len(self.pair_totals) + self.of.take(ids)) + BACK_CLASS
        return hits


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums along the last axis, as a product."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones((x.shape[-1], 1), dtype=x.dtype)).reshape(*x.shape[:-1], 1)


class Attention:
    """Parameters ``p`` (one float32 vector) and the batched forward and backward passes."""

    def __init__(self, skip: np.ndarray, p: np.ndarray | None = None, seed: int = 5):
        k, d = skip.shape[1], WIDTH
        self.groups = int(k ** 0.5)
        self.size = k // self.groups
        self.skip = skip  # p(class | row of the id before)
        self.prior = skip.reshape(-1, self.size)  # by row and group
        self.group_prior = skip.reshape(-1, self.groups, self.size).sum(axis=2)
        # query, key and value of every row of `skip`, and of nothing there; then what all windows share
        self.rows = len(skip) + 1
        self.shapes = {"embed": (self.rows, 3 * d), "pos": (HOP, 2 * HOP),
                       "group": (d, self.groups), "sub": (self.groups, d, self.size)}
        sizes = [int(np.prod(s)) for s in self.shapes.values()]
        self.shapes["pad"] = (-sum(sizes) % (3 * d),)  # all parameters are rows of 3 WIDTH
        sizes.append(self.shapes["pad"][0])
        if p is None:
            rng = np.random.default_rng(seed)
            p = rng.normal(0, 0.1, sum(sizes)).astype(np.float32)
        self.p = p
        self.held: dict = {}  # working arrays
        self.group_numbers = np.arange(self.groups)[:, None]
        self.cuts = np.cumsum([0, *sizes])
        at, key = np.arange(HOP)[:, None] + HOP, np.arange(2 * HOP)[None, :]
        self.mask = np.where(key <= at, np.float32(0), _NEVER)
        names = list(self.shapes)
        self.shared_parts = [(a - self.cuts[1], b - self.cuts[1], self.shapes[name])
                             for name, a, b in zip(names[1:4], self.cuts[1:].tolist(), self.cuts[2:].tolist(), strict=False)]
        self.bounds = {name: (a, b) for name, a, b in
                       zip(names, self.cuts.tolist(), self.cuts[1:].tolist(), strict=False)}

    def part(self, name: str, p: np.ndarray | None = None) -> np.ndarray:
        a, b = self.bounds[name]
        return (self.p if p is None else p)[a:b].reshape(self.shapes[name])

    def _space(self, name: str, *shape: int) -> np.ndarray:
        """A working array that later calls use again; zero at first."""
        held = self.held.get(name)
        if held is None or held.shape[1:] != shape[1:] or len(held) < shape[0]:
            held = self.held[name] = np.zeros(shape, dtype=self.p.dtype)
        return held[:shape[0]]

    @cached_property
    def calm(self) -> bool:
        """Whether no exponent can pass the limit: what is attended to is a mean of values. For a net that learns no more."""
        value = np.abs(self.part("embed")[:, 2 * WIDTH:]).max(initial=0)
        return bool(1.01 * value * max(np.abs(self.part(x)).sum(axis=-2).max() for x in ("group", "sub")) < 60)

    def _attend(self, e: np.ndarray, nothing: tuple):
        """What the second half of each embedded window has attended to; also the unscaled attention as
        (windows, keys, queries) and its scale. ``nothing``: index of (window, place) that no query may see."""
        n, d = len(e), WIDTH
        turned, s, h = self._space("turned", n, d, HOP), self._space("s", n, 2 * HOP, HOP), self._space("h", n, HOP, d)
        np.multiply(e[:, HOP:, :d].transpose(0, 2, 1), self.p.dtype.type(1 / np.sqrt(d)), out=turned)
        np.matmul(e[:, :, d:2 * d], turned, out=s)
        s += (np.minimum(np.maximum(self.part("pos"), -40), 40) + self.mask).T.copy()
        np.exp(s, out=s)
        s[nothing] = 0
        scale = (1 / (np.ones((1, 2 * HOP), dtype=s.dtype) @ s)).transpose(0, 2, 1)
        np.matmul(s.transpose(0, 2, 1), e[:, :, 2 * d:], out=h)
        h *= scale
        return h, s, scale

    def shares(self, e: np.ndarray, nothing: tuple, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Probability of each class ``y`` after embedded windows: of its group, then of it in the group."""
        h = self._attend(e, nothing)[0].reshape(-1, WIDTH)
        group = (y // self.size).astype(np.uint8 if self.groups < 256 else int)
        order = np.argsort(group, kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(group, minlength=self.groups))).tolist()
        rows, y, h = rows.take(order).astype(np.int64), y.take(order).astype(np.int64), h.take(order, axis=0)
        group = y // self.size
        inside = self._space("inside", len(y), self.size)
        for g, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                np.matmul(h[a:b], self.part("sub")[g], out=inside[a:b])
        chosen = 1.0
        for z, prior, y in ((h @ self.part("group"), self.group_prior.take(rows, axis=0), group),
                            (inside, self.prior.take(rows * self.groups + group, axis=0), y - group * self.size)):
            if not self.calm:
                np.clip(z, -60, 60, out=z)
            np.exp(z, out=z)
            z *= prior
            chosen = chosen * z.reshape(-1).take(np.arange(0, z.size, z.shape[1]) + y).astype(float) / _sums(z)[:, 0]
        out = np.empty(len(y))
        out[order] = chosen
        return out

    def log_class(self, w: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log probability of the classes ``y`` (windows, HOP); ``rows``: of the ids before them.
        w: (windows, 2 HOP) rows, each of the id before a place; -1 is nothing there."""
        e = self.part("embed").take(np.where(w < 0, self.rows - 1, w), axis=0)
        return np.log(self.shares(e, np.nonzero(w < 0), rows.reshape(-1), y.reshape(-1))).reshape(y.shape)

    def gradient_rows(self, steps: Steps, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean loss over the real places of batch ``k``: the rows of ``p`` (as rows of
        3 WIDTH) that the windows touch, and their gradients."""
        there = steps.there[k]
        n, d, groups = len(there), WIDTH, self.groups
        e, de = self._space("e", n, 2 * HOP, 3 * d), self._space("de", n, 2 * HOP, 3 * d)
        self.part("embed").take(there, axis=0, out=e, mode="clip")
        hidden, a, scale = self._attend(e, steps.nothing(k))
        rest = np.zeros(len(self.p) - self.cuts[1], dtype=self.p.dtype)
        pos, out, sub = (rest[a:b].reshape(shape) for a, b, shape in self.shared_parts)
        # both choices, with the places in chunks of one group
        of, weight = steps.chunk_group[k], steps.weight[k].astype(e.dtype)
        h = hidden.reshape(-1, d).take(steps.slots[k], axis=0)
        by_chunk, kernel = h.reshape(-1, CHUNK, d), self.part("sub")
        among = h @ self.part("group")
        inside = (by_chunk @ kernel.take(of, axis=0)).reshape(-1, self.size)
        for z, prior, chosen in ((among, self.group_prior.take(steps.rows[k], axis=0), steps.chosen[0][k]),
                                 (inside, self.prior.take(steps.group_rows[k], axis=0), steps.chosen[1][k])):
            np.clip(z, -60, 60, out=z)
            np.exp(z, out=z)
            z *= prior
            z *= weight[:, None] / _sums(z)
            z.reshape(-1)[chosen] -= weight
        np.matmul(h.T, among, out=out)
        inside = inside.reshape(-1, CHUNK, self.size)
        np.matmul((of == self.group_numbers).astype(e.dtype), (by_chunk.transpose(0, 2, 1) @ inside).reshape(len(of), -1),
                  out=sub.reshape(groups, -1))
        back = (inside @ kernel.transpose(0, 2, 1).copy().take(of, axis=0)).reshape(-1, d)
        back += among @ self.part("group").T.copy()
        dh = back.take(steps.slot_of[k], axis=0).reshape(n, HOP, d)
        dh *= scale
        # attention
        turned, ds = self._space("turned", n, d, HOP), self._space("ds", n, 2 * HOP, HOP)
        np.copyto(turned, dh.transpose(0, 2, 1))
        np.matmul(e[:, :, 2 * d:], turned, out=ds)
        hidden *= dh  # its sum over the width is that of a * ds over the keys
        ds -= _sums(hidden).reshape(n, 1, HOP)
        ds *= a
        pos[:] = ds.sum(axis=0).T
        ds *= self.p.dtype.type(1 / np.sqrt(d))
        np.matmul(ds.transpose(0, 2, 1), e[:, :, d:2 * d], out=de[:, HOP:, :d])  # the first half has no queries
        np.matmul(ds, e[:, HOP:, :d], out=de[:, :, d:2 * d])
        np.matmul(a, dh, out=de[:, :, 2 * d:])
        sums = steps.summed(k, de.reshape(-1, 3 * d).take(steps.by_turn[k], axis=0))
        shared = rest.reshape(-1, 3 * d)
        return np.concatenate((steps.ids[k], np.arange(self.rows, self.rows + len(shared)))), np.concatenate((sums, shared))

    def gradient(self, w: np.ndarray, rows: np.ndarray, y: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Gradient of the mean loss over the ``real`` places, of all parameters."""
        g = np.zeros_like(self.p)
        at, value = self.gradient_rows(Steps(self, w[None], rows[None], y[None], real[None]), 0)
        g.reshape(-1, 3 * WIDTH)[at] = value
        return g


class Steps:
    """What the gradient steps of some batches need that depends on their windows alone, found for all at once.

    ``w`` (batches, windows, 2 HOP) are rows before each place, -1 for nothing; ``rows``, ``y`` and ``real``
    (batches, windows, HOP) those before the predicted places, their classes, and which places count."""

    def __init__(self, net: Attention, w: np.ndarray, rows: np.ndarray, y: np.ndarray, real: np.ndarray):
        self.there = np.where(w < 0, net.rows - 1, w)
        self.begins = (w[:, :, 0] < 0).any(axis=1).tolist()
        self.w = w
        many = len(w)
        self._chunks(net, *(x.reshape(many, -1) for x in (rows, y, real)))
        self._turns(net, self.there.reshape(many, -1))

    def nothing(self, k: int) -> tuple:
        """Index of the places in the windows that lie before their text."""
        return np.nonzero(self.w[k] < 0) if self.begins[k] else ([], [])

    def _chunks(self, net: Attention, rows: np.ndarray, y: np.ndarray, real: np.ndarray) -> None:
        """Predicted places in order of their class's group, each group filled up to whole chunks with
        places of weight zero, so that all chunks of a batch are multiplied together."""
        many, places = y.shape
        group = (y // net.size).astype(np.uint8 if net.groups < 256 else np.int64)
        order = np.argsort(group, axis=1, kind="stable")
        flat = (order + np.arange(0, y.size, places)[:, None]).reshape(-1)
        counts = np.stack([np.bincount(g, minlength=net.groups) for g in group])
        chunks = -(-counts // CHUNK)
        n = -(-places // CHUNK) + net.groups  # chunks at most
        spare = n - chunks.sum(axis=1)
        numbers = np.append(np.tile(np.arange(net.groups), many).reshape(many, -1),
                            np.full((many, 1), net.groups - 1), axis=1)
        self.chunk_group = np.repeat(numbers.reshape(-1), np.append(chunks, spare[:, None], axis=1).reshape(-1)).reshape(many, n)
        shift = (np.cumsum(chunks, axis=1) - chunks) * CHUNK - (np.cumsum(counts, axis=1) - counts)
        slot = np.arange(places) + np.repeat(shift.reshape(-1), counts.reshape(-1)).reshape(many, places)
        to = (slot + np.arange(0, many * n * CHUNK, n * CHUNK)[:, None]).reshape(-1)
        wide = many * n * CHUNK
        slots, slot_of = np.zeros(wide, dtype=np.int64), np.empty(y.size, dtype=np.int64)
        slots[to], slot_of[flat] = order.reshape(-1), slot.reshape(-1)
        weight, within, before = np.zeros(wide, dtype=np.float32), np.zeros(wide, dtype=np.int64), np.zeros(wide, dtype=np.int64)
        weight[to] = (real / np.maximum(1, real.sum(axis=1, keepdims=True))).reshape(-1).take(flat)
        within[to], before[to] = (y % net.size).reshape(-1).take(flat), rows.reshape(-1).take(flat)
        group = np.repeat(self.chunk_group, CHUNK, axis=1)
        self.slots, self.weight, self.rows = (x.reshape(many, -1) for x in (slots, weight, before))
        self.slot_of = slot_of.reshape(many, places)
        self.group_rows = self.rows * net.groups + group
        self.chosen = (np.arange(0, n * CHUNK * net.groups, net.groups) + group,
                       np.arange(0, n * CHUNK * net.size, net.size) + within.reshape(many, -1))

    def _turns(self, net: Attention, at: np.ndarray) -> None:
        """Places in turns: the first of every row, the second of those that have one, and so on, most
        frequent rows first, so that a turn is added to a slice of the sums; after TURNS, row by row."""
        many, places = at.shape
        order = np.argsort(at.astype(np.uint16) if net.rows < 1 << 16 else at, axis=1, kind="stable")  # 16 bits: radix
        order += np.arange(0, at.size, places)[:, None]
        at = at.reshape(-1).take(order)
        new = np.ones(at.shape, dtype=bool)
        new[:, 1:] = at[:, 1:] != at[:, :-1]
        first = np.flatnonzero(new)
        counts, batch = np.diff(np.append(first, at.size)), first // places
        rank = np.empty(len(first), dtype=np.int64)
        best = np.argsort(batch * (places + 1) + places - counts, kind="stable")
        starts = np.searchsorted(batch, np.arange(many + 1))
        rank[best] = np.arange(len(first)) - starts[batch]
        ids = at.reshape(-1)[first[best]]
        self.ids = [ids[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        often = np.bincount(batch * (TURNS + 2) + np.minimum(counts, TURNS + 1), minlength=many * (TURNS + 2))
        sizes = often.reshape(many, -1)[:, ::-1].cumsum(axis=1)[:, TURNS::-1]  # rows with more than 0, 1, ... places
        self.sizes = sizes.tolist()
        begins = np.cumsum(sizes, axis=1) - sizes
        left = np.maximum(counts[best] - TURNS, 0)
        before = np.cumsum(left) - left
        before -= before[np.minimum(starts[:-1], len(before) - 1)][batch]
        self.rests = [before[a:a + s[-1]] for a, s in zip(starts, self.sizes, strict=False)]
        segment = np.repeat(np.arange(len(first)), counts)
        turn = np.arange(at.size) - first[segment]
        begins += np.arange(0, at.size, places)[:, None]
        to = begins.reshape(-1).take((batch * (TURNS + 1))[segment] + np.minimum(turn, TURNS)) + rank[segment]
        late = np.flatnonzero(turn >= TURNS)
        of = segment[late]
        to[late] += before[starts[batch[of]] + rank[of]] + turn[late] - TURNS - rank[of]
        self.by_turn = np.empty(at.size, dtype=np.int64)
        self.by_turn[to] = order.reshape(-1)
        self.by_turn = self.by_turn.reshape(many, places) - np.arange(0, at.size, places)[:, None]

    def summed(self, k: int, x: np.ndarray) -> np.ndarray:
        """Sums of the rows ``x``, places as in ``by_turn``, by id as in ``ids``."""
        sizes = self.sizes[k]
        total, at = x[:sizes[0]], sizes[0]
        for m in sizes[1:-1]:
            total[:m] += x[at:at + m]
            at += m
        if sizes[-1]:
            # numbers two by two, as complex ones: half as many sums to start
            pairs = x[at:].view(np.result_type(x, 1j))
            total[:sizes[-1]] += np.add.reduceat(pairs, self.rests[k], axis=0).view(x.dtype)
        return total


def windows(bounds: np.ndarray):
    """Windows over texts laid end to end: place of each window's first predicted symbol, and its text."""
    per_text = -(-np.diff(bounds) // HOP)
    text = np.repeat(np.arange(len(per_text)), per_text)
    hop = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return bounds[:-1][text] + hop * HOP, text


def turn_windows(bounds: np.ndarray, turn: int) -> np.ndarray:
    """The windows (by number) that learn in a round: each in one round, neighbours in different ones."""
    place, text = windows(bounds)
    return np.flatnonzero(((place - bounds[:-1][text]) // HOP + text) % ROUNDS == turn)


def window_rows(before: np.ndarray, bounds: np.ndarray, first: np.ndarray, text: np.ndarray):
    """What stands before each place of the windows (-1 before the text), their places, and which are real."""
    at = first[:, None] + np.arange(-HOP, HOP)
    real = at[:, HOP:] < bounds[1:][text][:, None]
    w = np.where(at >= bounds[:-1][text][:, None], before[np.clip(at, 0, len(before) - 1)], -1)
    return w, np.minimum(at[:, HOP:], len(before) - 1), real


def batches_of(pick: np.ndarray) -> Iterator[np.ndarray]:
    """Windows in batches of BATCH, as arrays (batches, windows) of some of them; the last may be short."""
    full = len(pick) // BATCH * BATCH
    for k in range(0, full, BATCH * TOGETHER):
        yield pick[k:min(k + BATCH * TOGETHER, full)].reshape(-1, BATCH)
    if full < len(pick):
        yield pick[full:][None]


def step_arrays(rows: np.ndarray, after: np.ndarray, bounds: np.ndarray, place: np.ndarray, text: np.ndarray):
    """The arrays of :class:`Steps` for batches of windows (their places and texts: batches, windows)."""
    w, at, real = window_rows(rows, bounds, place.reshape(-1), text.reshape(-1))
    return (x.reshape(*place.shape, -1) for x in (w, rows[at], after[at], real))


class Adam:
    """Adam steps on the rows that a batch touches, each corrected for the steps that it has taken."""

    def __init__(self, net: Attention, rate: np.float32):
        self.net, self.rate, self.step = net, rate, 0
        self.p = net.p.reshape(-1, 3 * WIDTH)
        self.first, self.second = np.zeros_like(self.p), np.zeros_like(self.p)
        self.taken = np.zeros(len(self.p), dtype=np.int64)
        n = np.arange(1, 4000, dtype=np.float32)[:, None]  # from there on the corrections are one
        self.corrections = np.concatenate((1 / (1 - np.float32(0.9) ** n), 1 / (1 - np.float32(0.99) ** n)), axis=1)

    def learn(self, steps: Steps) -> None:
        # whole rows are written as one item each, which numpy does faster than by numbers
        item = f"V{self.p.itemsize * self.p.shape[1]}"
        kept = [x.view(item).reshape(-1) for x in (self.p, self.first, self.second)]
        for k in range(len(steps.there)):
            self.step += 1
            i, g = self.net.gradient_rows(steps, k)
            n = self.taken.take(i)
            self.taken[i] = n + 1
            p, first, second = (x.take(i, axis=0) for x in (self.p, self.first, self.second))
            first *= np.float32(0.9)
            first += np.float32(0.1) * g
            g *= g
            g *= np.float32(0.01)
            second *= np.float32(0.99)
            second += g
            correct = self.corrections.take(np.minimum(n, len(self.corrections) - 1), axis=0)
            root = np.multiply(second, correct[:, 1:], out=g)
            np.sqrt(root, out=root)
            root += np.float32(1e-6)
            move = first * (correct[:, :1] * np.float32(self.rate / (1 + self.step / 500)))
            move /= root
            p -= move
            for to, x in zip(kept, (p, first, second), strict=True):
                to[i] = x.view(item).reshape(-1)


@dataclass
class Model:
    tables: Tables
    net: Attention

    def symbol_logs(self, flat: np.ndarray, before: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log probability of every symbol of texts laid end to end."""
        t, net = self.tables, self.net
        out = t.within(t.of.take(before), flat)
        rows, after = t.row.take(before), t.of.take(flat)
        first, text = windows(bounds)
        begins, ends = first == bounds[:-1][text], bounds[1:][text]
        embed, places, done = net.part("embed"), np.arange(HOP), 0
        per = 512  # windows at a time
        for k in range(0, len(first), per):
            # the second half of a window is the first half of the next one, but for a text's first window
            lead = max(k - 1, 0)
            at = first[lead:k + per, None] + places
            real = at[k - lead:] < ends[k:k + per, None]
            np.minimum(at, len(rows) - 1, out=at)
            e = embed.take(rows.take(at), axis=0)
            if k == 0:
                e = np.concatenate((e[:1], e))
            at = at[k - lead:].reshape(-1)
            n, (_, across, along) = len(e) - 1, e.strides
            pairs = np.lib.stride_tricks.as_strided(e, (n, 2 * HOP, e.shape[2]), (HOP * across, across, along), writeable=False)
            hit = net.shares(pairs, (np.flatnonzero(begins[k:k + per]), slice(HOP)), rows.take(at), after.take(at))
            hit = hit[real.reshape(-1)]
            out[done:done + len(hit)] *= hit  # windows follow one another as the texts do
            done += len(hit)
        return np.log(out, out=out)

    def score(self, ids: list[bytes]) -> np.ndarray:
        """Log10 probability of each text from its packed subword ids."""
        if not ids:
            return np.zeros(0)
        flat, before, bounds = _closed(ids, len(self.tables.of) - 1)
        return np.add.reduceat(self.symbol_logs(flat, before, bounds), bounds[:-1]) / np.log(10)


def _closed(ids: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by the end id; the id before each (the end id before a text); bounds."""
    tail = np.array([end], dtype="<u2").tobytes()
    bounds = np.append(0, np.cumsum([len(x) // 2 + 1 for x in ids]))
    flat = np.frombuffer(b"".join([x + tail for x in ids]), dtype="<u2").astype(np.int64)
    return flat, np.append(end, flat[:-1]), bounds


def _portions(batches: Iterator[pa.RecordBatch], limit: int = 2 << 20) -> Iterator[list[bytes]]:
    """Packed ids of the rows, in lists of about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        for x in batch.column("ids").to_pylist():
            held.append(x)
            size += len(x)
            if size > limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _summed(rows: DataFrame, run, size: int) -> np.ndarray:
    """Adds up the vectors of ``size`` numbers that ``run`` yields per task; Spark adds, by index."""

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for vector in run(batches):
            at = np.flatnonzero(vector)
            values = pa.array(vector[at].astype(float), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), values], ["i", "x"])

    out = np.zeros(size)
    sums = rows.mapInArrow(sparse, "i int, x double").groupBy("i").agg(F.sum("x").alias("x"))
    got = sums.toPandas()  # at most `size` rows
    out[got["i"].to_numpy(dtype=int)] = got["x"]
    return out


def train(train_rows: DataFrame, n_ids: int) -> Model:
    """Model from all training rows (column ``ids``); ids below ``n_ids``, the end is ``n_ids``."""

    def unigrams(batches):
        total = np.zeros(n_ids + 1, dtype=np.int64)
        for ids in _portions(batches):
            total += np.bincount(_closed(ids, n_ids)[0], minlength=n_ids + 1)
        yield total

    tables = Tables.of_ids(_summed(train_rows, unigrams, n_ids + 1))
    seen, k = tables.seen, CLASSES

    def conditionals(batches):
        after, then = np.zeros(seen * k, dtype=np.int64), np.zeros(k * (seen + 1), dtype=np.int64)
        for ids in _portions(batches):
            flat, before, _ = _closed(ids, n_ids)
            after += np.bincount(tables.column[before] * k + tables.of[flat], minlength=len(after))
            then += np.bincount(tables.of[before] * (seen + 1) + tables.column[flat], minlength=len(then))
        yield np.concatenate((after, then))

    if seen:
        both = _summed(train_rows, conditionals, seen * k + k * (seen + 1))
    else:
        both = np.zeros(k)
    tables.fill(both[:seen * k].reshape(seen, k), both[seen * k:].reshape(k, seen + 1))
    net = Attention(tables.skip)
    net.p = _with_class_rows(net, tables)
    for turn in range(ROUNDS):
        net = Attention(tables.skip, _averaged(train_rows, net, tables, n_ids, turn))
        net.p = _with_class_rows(net, tables)
    return Model(tables, net)


def _with_class_rows(net: Attention, tables: Tables) -> np.ndarray:
    """The parameters with each class's own row (for ids not seen) the mean of its seen ids' rows."""
    own = Attention(net.skip, net.p.copy())
    embed, n = own.part("embed"), len(tables.pair_totals)
    known = np.flatnonzero(tables.row < tables.seen)
    total, weight = np.zeros((n, embed.shape[1])), np.zeros(n)
    np.add.at(total, tables.of[known], tables.share[known, None] * embed[tables.row[known]])
    np.add.at(weight, tables.of[known], tables.share[known])
    some = np.flatnonzero(weight)
    embed[tables.seen + some] = total[some] / weight[some, None]
    return own.p


def _averaged(train_rows: DataFrame, net: Attention, tables: Tables, n_ids: int, turn: int) -> np.ndarray:
    """Parameters after every task's own pass over its windows, row by row averaged by steps taken."""
    shared = train_rows.sparkSession.sparkContext.broadcast((tables, net))  # bounded: ids seen x classes
    columns = [f"x{c}" for c in range(3 * WIDTH)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, net = shared.value
        adam = Adam(Attention(net.skip, net.p.copy()), np.float32(RATE / (1 + turn)))
        rng = np.random.default_rng([turn, TaskContext.get().partitionId()])
        for ids in _portions(batches):
            flat, before, bounds = _closed(ids, n_ids)
            rows, after = tables.row[before], tables.of[flat]
            place, text = windows(bounds)
            pick = rng.permutation(turn_windows(bounds, turn))
            for some in batches_of(pick):
                adam.learn(Steps(adam.net, *step_arrays(rows, after, bounds, place[some], text[some])))
        p, taken = adam.p, adam.taken
        i = np.flatnonzero(taken)
        weighted = (p[i] * taken[i, None].astype(float)).T
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(taken[i]), *map(pa.array, weighted)],
                                         ["i", "n", *columns])

    sums = train_rows.mapInArrow(learn, ", ".join(["i int", "n long", *(f"{c} double" for c in columns)])) \
        .groupBy("i").agg(*[F.sum(c).alias(c) for c in ["n", *columns]])
    got = sums.toPandas()  # a row per id seen at most
    out = net.p.copy()
    out.reshape(-1, 3 * WIDTH)[got["i"].to_numpy(dtype=int)] = got[columns].to_numpy() / got["n"].to_numpy()[:, None]
    return out


# ---------------------------------------------------------------- scores

def score(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    vocabulary = vocabulary or default_path()
    docs = prepared(docs, doc_id="bigint", text="string")
    texts = docs.withColumn("train", ~held_out())
    written = keep(blocks(texts, vocabulary, SLICES), "zstd")
    rows = written.where("row is not null").select("block", "row", "doc_id", "words", "ids")
    words = written.where("slice is not null").select("block", "slice", "size", "spelled", "codes", "n")
    # a word has one entry per block: its entries are as many as the blocks it occurs in
    entries = words.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    parts = min(SLICES, max(1, -(-entries // PART_WORDS)))
    counted = keep(words.groupBy((F.col("slice") % parts).alias("part")).applyInArrow(
        _count, "block long, codes binary, c binary, n long, v long"), "zstd")
    train_rows = rows.where(~held_out())
    n_train = train_rows.count()  # so many end tokens
    total = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v")]).first()
    n_tokens, distinct = total["n"] + n_train, total["v"] + (n_train > 0)
    floor = float(np.log10(n_tokens + 0.1 * (distinct + 1)))
    model = train(train_rows, encoder(vocabulary).size)

    def base(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        codes, c = np.frombuffer(b"".join(right["codes"]), dtype="<u4"), np.frombuffer(b"".join(right["c"]), dtype="<i8")
        counts = np.zeros(int(codes.max(initial=0)) + 1)
        counts[codes] = c
        logs, known = np.log10(counts + 0.1), counts > 0
        out = []
        for row, codes in zip(left["row"], left["words"], strict=True):
            at = unpacked(codes)
            out.append((row, len(at) + 1, int(known[at].sum()) + (n_train > 0),
                        float(logs[at].sum() + np.log10(n_train + 0.1) - (len(at) + 1) * floor)))
        return pd.DataFrame(out, columns=["row", "n_tokens", "n_known", "base_score"]) \
            .assign(block=left["block"].iloc[0] if len(left) else 0)

    based = rows.select("block", "row", "words").groupBy("block").cogroup(
        counted.select("block", "codes", "c").groupBy("block")).applyInPandas(
        base, "row int, n_tokens long, n_known long, base_score double, block long")

    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: ids seen x classes

    def attend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("ids").to_pylist()
            got, at = np.zeros(len(raw)), 0
            for part in _portions(iter([batch])):
                got[at:at + len(part)] = shared.value.score(part)
                at += len(part)
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("row"), batch.column("doc_id"),
                                              pa.array(got, pa.float64())], ["block", "row", "doc_id", "score"])

    scored = rows.select("block", "row", "doc_id", "ids") \
        .mapInArrow(attend, "block long, row int, doc_id long, score double")
    return scored.join(based, ["block", "row"]).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")

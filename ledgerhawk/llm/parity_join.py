"""Jaccard join of word-shingle sets by parity sketches.

1. A text's set: the 64-bit hashes of its distinct shingles. Equal sets are one class
   (128-bit digest), so copies never meet each other again.
2. Sketch: every shingle flips one bit of a sketch of ``blocks`` blocks. Two sketches
   differ in at most as many bits, so in at most as many blocks, as the sets have
   elements of their own (the symmetric difference D). At a similarity of t or more,
   D <= (1 - t) / (1 + t) * (both sizes added): ``most`` for the worst partner of a set.
3. Pigeonhole, per size band: bands overlap by 1/t, so that two linked sets share one,
   and with it the same sketch layout. Of the blocks that agree, at least ``blocks - most``,
   the richest in set bits is among the ``most + 1`` richest of *both* sets: were
   it not, all agreeing blocks would be among the other ``blocks - most - 1``. So a set is
   joined on its ``most + 1`` richest blocks only (a key is the XOR of its set
   bits' hashes); poor blocks, on which strangers agree by chance, are mostly left out.
4. Verify: of each key's members the best connected one is compared with all others
   (exact intersection of the sets). Others that are then still in different
   components are compared with each other, in chunks of bounded size, after a
   second, short parity sketch has ruled out the pairs that differ in too many bits.
   It grows with the set (a fixed one says nothing of sets that flip all its bits) and
   folds: two sketches are compared at the length of the shorter one.
5. Components of the links, then the smallest doc_id of each.

The sets themselves are made again for the candidates only: a bitmap of fixed size,
broadcast, tells which texts to cut into shingles once more.

Defined cases: NULL, empty and blank texts have no set and are linked with nothing;
texts of fewer words than a shingle have their whole sequence as one; repeated
rows get a row each; NULL doc_ids name a component only if it has no other id; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct_pieces, keep, prepared, text_groups
from .dense import mixed
from .simhash import components

SHINGLE = 5
#: Linked if ``OF * intersection >= AT_LEAST * union``.
AT_LEAST, OF = 80, 100
#: Shingles a block, for the largest sets of a band, and growth of the sizes from band to band.
LOAD, BAND = 3.3, 2.4
#: Bits of a block (they exist as hashes only), least and most words of the short sketch, bits of the bitmap of candidates.
_BIT, _SHORT, _LONG, _MARKS = 16, 8, 64, 1 << 23
CHUNK = 256
_U = np.uint64


class Bands:
    """Size bands and how many blocks a set of each size is joined on."""

    def __init__(self, at_least: int = AT_LEAST, of: int = OF):
        self.at_least, self.of = at_least, of

    def most(self, n: np.ndarray) -> np.ndarray:
        """The largest symmetric difference of a set of ``n`` and any set linked with it."""
        return self.apart(n + n * self.of // self.at_least)

    def apart(self, both: np.ndarray) -> np.ndarray:
        """The largest symmetric difference of linked sets whose sizes add up to ``both``."""
        return both * (self.of - self.at_least) // (self.of + self.at_least)

    def edges(self, upto: int) -> np.ndarray:
        """First size of each band, up to one beyond ``upto``; smaller sets are linked with equal ones only."""
        first = 1
        while first <= upto and self.most(np.int64(first)) == 0:
            first += 1
        out = [first]
        while out[-1] <= upto:
            out.append(int(out[-1] * BAND) + 1)
        return np.array(out, dtype=np.int64)

    def largest(self, edges: np.ndarray) -> np.ndarray:
        """The largest size that takes part in each band: linked with a size of its own."""
        return (edges[1:] - 1) * self.of // self.at_least

    def blocks(self, edges: np.ndarray) -> np.ndarray:
        top = self.largest(edges)
        return np.maximum(np.ceil(top / LOAD).astype(np.int64), self.most(top) + 1)


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The texts' words: :func:`distinct_pieces` without the empty piece at a text's ends."""
    codes, distinct, offsets = distinct_pieces(texts)
    if "" in distinct:
        kept = codes != distinct.index("")
        codes, offsets = codes[kept], np.concatenate([[0], np.cumsum(kept)])[offsets]
    return codes, distinct, offsets


def shingle_sets(texts: pa.Array, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)``: the sorted distinct shingle hashes of each text."""
    from xxhash import xxh64_intdigest

    codes, distinct, offsets = words_of(texts)
    n = len(offsets) - 1
    of_word = np.array([xxh64_intdigest(w.encode()) for w in distinct], dtype=_U)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    h = of_word[codes] if len(codes) else np.zeros(0, dtype=_U)
    hashes, docs = np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    if len(h) >= words:
        last = len(h) - words + 1
        acc = mixed(h[:last], words)
        for j in range(1, words):
            acc = mixed(acc * _U(3) + h[j:last + j], words)
        inside = doc[:last] == doc[words - 1:]
        hashes, docs = acc[inside], doc[:last][inside]
    sizes = np.diff(offsets)
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    if len(short):
        whole = []
        for i in short.tolist():
            acc = mixed(h[offsets[i]:offsets[i] + 1], 0)
            for j in range(1, int(sizes[i])):
                acc = mixed(acc * _U(3) + h[offsets[i] + j:offsets[i] + j + 1], j)
            whole.append(acc)
        hashes, docs = np.concatenate([hashes, *whole]), np.concatenate([docs, short])
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[new], docs[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=n))]).astype(np.int64)


def digests(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that together name each set."""
    out = []
    for seed in (101, 102):
        total = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(mixed(hashes, seed), dtype=_U)])
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def short_sketches(hashes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Parity sketches of 1.6 bits or more an element (if ``_LONG`` allows): a power of two of 64-bit words,
    from ``_SHORT`` to ``_LONG``."""
    sizes = np.diff(offsets)
    words = np.left_shift(1, np.ceil(np.log2(np.clip(sizes / 40, _SHORT, _LONG))).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(words * 64)])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    bit = (mixed(hashes, 55) & (words[doc] * 64 - 1).astype(_U)).astype(np.int64)
    flips = np.bincount(ends[doc] + bit, minlength=int(ends[-1])) & 1
    packed = np.packbits(flips.astype(np.uint8), bitorder="little")
    return [packed[a:b].tobytes() for a, b in zip(ends // 8, ends[1:] // 8, strict=False)]


def folded(sketches: list[bytes], words: int) -> np.ndarray:
    """The sketches (of ``words`` or more) as the sketches of ``words`` words of the same sets, one a row."""
    out = np.empty((len(sketches), words), dtype="<u8")
    for i, x in enumerate(sketches):
        np.bitwise_xor.reduce(np.frombuffer(x, dtype="<u8").reshape(-1, words), axis=0, out=out[i])
    return out


def block_keys(hashes: np.ndarray, offsets: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, offsets)``: what each set is joined on, over the one or two bands of its size."""
    sizes = np.diff(offsets)
    edges = bands.edges(int(sizes.max(initial=0)))
    own = np.searchsorted(edges, sizes, side="right") - 1
    blocks, top = bands.blocks(edges), bands.largest(edges)
    doc, band = [np.flatnonzero(own >= 0)], [own[own >= 0]]
    lower = np.flatnonzero((own >= 1) & (sizes <= top[np.maximum(own - 1, 0)])) if len(top) else np.zeros(0, dtype=np.int64)
    doc, band = np.concatenate([*doc, lower]), np.concatenate([*band, own[lower] - 1])
    if not len(doc):
        return np.zeros(0, dtype=np.int64), np.zeros(len(sizes) + 1, dtype=np.int64)
    # one run of elements for each (set, band)
    n = sizes[doc]
    run = np.repeat(np.arange(len(doc)), n)
    h = hashes[np.arange(int(n.sum())) + np.repeat(offsets[doc] - (np.cumsum(n) - n), n)]
    cell = mixed(h ^ mixed(band[run].astype(_U), 7), 8)
    at = ((cell >> _U(32)) * blocks[band[run]].astype(_U)) >> _U(32)
    cell = at << _U(_BIT) | cell & _U((1 << _BIT) - 1)
    order = np.lexsort((cell, run))
    cell, run = cell[order], run[order]
    starts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (run[1:] != run[:-1])]))
    odd = starts[np.diff(np.append(starts, len(cell))) & 1 == 1]  # bits that an odd number of elements flip
    cell, run = cell[odd], run[odd]
    at = (cell >> _U(_BIT)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (run[1:] != run[:-1])])) if len(cell) else np.zeros(0, dtype=np.int64)
    rich = np.diff(np.append(starts, len(cell)))
    content = np.bitwise_xor.reduceat(mixed(cell, 9), starts) if len(starts) else np.zeros(0, dtype=_U)
    run, at = run[starts] if len(starts) else run, at[starts] if len(starts) else at
    need = bands.most(n) + 1
    order = np.lexsort((-at, -rich, run))
    run, at, content = run[order], at[order], content[order]
    have = np.bincount(run, minlength=len(doc))
    place = np.arange(len(run)) - np.repeat(np.cumsum(have) - have, have)
    taken = place < need[run]
    runs, ats, contents = [run[taken]], [at[taken]], [content[taken]]
    for i in np.flatnonzero(have < need).tolist():  # too few blocks have a bit: the last empty ones as well
        full = set(at[run == i].tolist())
        empty = [b for b in range(int(blocks[band[i]]) - 1, -1, -1) if b not in full][:int(need[i] - have[i])]
        runs.append(np.full(len(empty), i))
        ats.append(np.array(empty, dtype=np.int64))
        contents.append(np.zeros(len(empty), dtype=_U))
    run, at, content = np.concatenate(runs), np.concatenate(ats), np.concatenate(contents)
    keys = mixed(content ^ mixed(band[run].astype(_U) << _U(40) | at.astype(_U), 10), 11).view(np.int64)
    order = np.argsort(doc[run], kind="stable")
    per_set = np.bincount(doc[run], minlength=len(sizes))
    return keys[order], np.concatenate([[0], np.cumsum(per_set)]).astype(np.int64)


def _ids(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n, d1, d2``: set size and digest of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            hashes, offsets = shingle_sets(batch.column("text"), words)
            d1, d2 = digests(hashes, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(d1), pa.array(d2)],
                                             ["doc_id", "n", "d1", "d2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, d1 bigint, d2 bigint")


def _classes(docs: DataFrame, words: int, bands: Bands) -> DataFrame:
    """One row per distinct set: ``sid, n, d1, d2, least_id, mark, short, keys``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            hashes, offsets = shingle_sets(batch.column("text"), words)
            d1, d2 = digests(hashes, offsets)
            keys, ends = block_keys(hashes, offsets, bands)
            some = pa.array(np.diff(offsets) > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(np.diff(offsets)), pa.array(d1), pa.array(d2),
                 pa.array(short_sketches(hashes, offsets), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys))],
                ["doc_id", "mark", "n", "d1", "d2", "short", "keys"]).filter(some)

    rows = docs.mapInArrow(run, "doc_id bigint, mark int, n bigint, d1 bigint, d2 bigint, short binary, keys array<bigint>")
    return rows.groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("least_id"), F.first("mark").alias("mark"), F.first("short").alias("short"),
        F.first("keys").alias("keys")).withColumn("sid", F.monotonically_increasing_id())


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``sid, n, members``: the sets of the classes ``wanted (sid, n, d1, d2, mark)``."""
    marked = np.zeros(_MARKS, dtype=bool)
    marked[[r.mark for r in wanted.select("mark").distinct().collect()]] = True  # at most _MARKS rows
    marks = docs.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = marks.value, set()
        for batch in text_groups(batches):
            mark = batch.column("mark").to_numpy()
            batch = batch.filter(pa.array(bits[mark >> 3] >> (7 - (mark & 7)) & 1 == 1))
            if not batch.num_rows:
                continue
            hashes, offsets = shingle_sets(batch.column("text"), words)
            d1, d2 = (d.tolist() for d in digests(hashes, offsets))
            at, rows = offsets.tolist(), []
            for i, name in enumerate(zip(d1, d2, strict=True)):
                if at[i + 1] > at[i] and name not in seen:  # copies: once a task
                    seen.add(name)
                    rows.append((i, *name))
            if len(seen) > 200_000:
                seen.clear()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([at[r[0] + 1] - at[r[0]] for r in rows], pa.int64()),
                     pa.array([hashes[at[r[0]]:at[r[0] + 1]].tobytes() for r in rows], pa.binary())],
                    ["d1", "d2", "n", "members"])

    made = docs.select("text", "mark").mapInArrow(run, "d1 bigint, d2 bigint, n bigint, members binary")
    return made.groupBy("d1", "d2", "n").agg(F.first("members").alias("members")) \
        .join(wanted.select("sid", "d1", "d2", "n"), ["d1", "d2", "n"]).select("sid", "members")


def verified(pairs: DataFrame, sets: DataFrame, at_least: int = AT_LEAST, of: int = OF) -> DataFrame:
    """The ``pairs (a, b)`` whose exact intersection links them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), dtype=_U), np.frombuffer(y.as_buffer(), dtype=_U)
                both = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(of * both >= at_least * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    of_a, of_b = sets.select(F.col("sid").alias("a"), F.col("members").alias("x")), sets.select(F.col("sid").alias("b"), F.col("members").alias("y"))
    return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _hubs(members: DataFrame) -> DataFrame:
    """``key, sid, hub``: each key's best connected member, beside every other one."""
    weight = members.groupBy("sid").agg(F.sum("n_members").alias("weight"))
    hub = members.join(weight, "sid").groupBy("key").agg(F.max(F.struct("weight", "sid"))["sid"].alias("hub"))
    return members.join(hub, "key").where("sid <> hub").select("key", "sid", "hub")


def _stars(spokes: DataFrame) -> DataFrame:
    """``(a, b)``, a > b: the hubs with the others of their keys."""
    return spokes.select(F.greatest("sid", "hub").alias("a"), F.least("sid", "hub").alias("b")).distinct()


def _apart(spokes: DataFrame, roots: DataFrame, shorts: DataFrame, bands: Bands, chunk: int) -> DataFrame:
    """``(a, b)``, a > b: members of a key, other than its hub, in different components that
    their short sketches do not rule out."""
    labelled = spokes.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left") \
        .select("key", "sid", F.coalesce("root", "sid").alias("root"))
    open_keys = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n_open")) \
        .where("lo < hi").select("key", F.ceil(F.col("n_open") / F.lit(chunk)).cast("int").alias("chunks"))
    dealt = labelled.join(open_keys, "key").join(shorts, "sid") \
        .withColumn("mine", F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    groups = dealt.groupBy("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")) \
        .agg(F.collect_list(F.struct("sid", "root", "n", "short", "mine")).alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # pairs share many keys: once a task
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for i, j, held in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "held")), strict=True):
                held.sort(key=lambda m: len(m["short"]))
                sid, root, n = (np.array([m[c] for m in held], dtype=np.int64) for c in ("sid", "root", "n"))
                mine, words, first = np.array([m["mine"] for m in held]), 0, 0
                for k in range(len(held) - 1):
                    if len(held[k]["short"]) // 8 != words:  # the later ones are as long or longer
                        words, first = len(held[k]["short"]) // 8, k
                        bits = folded([m["short"] for m in held[k:]], words)
                    far = np.bitwise_count(bits[k + 1 - first:] ^ bits[k - first]).sum(axis=1, dtype=np.int64)
                    close = (root[k + 1:] != root[k]) & (far <= bands.apart(n[k + 1:] + n[k]))
                    if i != j:
                        close &= mine[k + 1:] != mine[k]
                    found.update((max(int(sid[k]), s), min(int(sid[k]), s)) for s in sid[k + 1:][close].tolist())
            found -= seen
            seen |= found
            if len(seen) > 200_000:
                seen.clear()
            a, b = (list(x) for x in zip(*found, strict=True)) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return groups.select("i", "j", "held").mapInArrow(run, "a bigint, b bigint").distinct()


def join(docs: DataFrame, words: int = SHINGLE, at_least: int = AT_LEAST, of: int = OF, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    bands = Bands(at_least, of)
    docs = prepared(docs, doc_id="bigint", text="string") \
        .withColumn("mark", F.pmod(F.xxhash64("text"), F.lit(_MARKS)).cast("int"))
    classes = keep(_classes(docs, words, bands))
    rows = classes.select(F.explode("keys").alias("key"), "sid")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_members")).where("n_members > 1")
    members = keep(rows.join(shared, "key"))
    wanted = keep(members.select("sid").distinct().join(classes.select("sid", "n", "d1", "d2", "mark", "short"), "sid"))
    sets = keep(_sets_of(docs, wanted, words))
    spokes = keep(_hubs(members))
    tried = keep(_stars(spokes))
    links = keep(verified(tried, sets, at_least, of))
    rest = _apart(spokes, components(links), wanted.select("sid", "n", "short"), bands, chunk)
    more = keep(verified(rest.join(tried, ["a", "b"], "left_anti"), sets, at_least, of))
    roots = components(links.union(more))
    named = classes.select("sid", "n", "d1", "d2", "least_id").join(roots, F.col("sid") == F.col("node"), "left") \
        .select("n", "d1", "d2", "least_id", F.coalesce("root", "sid").alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = keep(named.join(least, "root").select("n", "d1", "d2", "component_id"))
    return _ids(docs, words).join(named, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))

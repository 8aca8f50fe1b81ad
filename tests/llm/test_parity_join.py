"""Parity-sketch Jaccard join against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import none, odd, sample  # noqa: F401

from ledgerhawk.llm import parity_join as pj


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 80), st.integers(0, 80), st.integers(0, 10**6))
def test_linked_sets_share_a_key(common, only_a, only_b, seed):
    rng = np.random.default_rng(seed)
    every = np.unique(rng.integers(0, 2**63, common + only_a + only_b, dtype=np.uint64))
    rng.shuffle(every)
    a, b = np.sort(np.delete(every, slice(common, common + only_a))), np.sort(every[:common + only_a])
    union = len(np.union1d(a, b))
    both = len(a) + len(b) - union
    keys, offsets = pj.block_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), pj.Bands())
    if 100 * both >= 80 * union and union > both:
        assert set(keys[:offsets[1]].tolist()) & set(keys[offsets[1]:].tolist())
    bands = pj.Bands()
    for x, k in ((a, offsets[1]), (b, offsets[2] - offsets[1])):  # a band more at the edges
        assert k in (0, bands.most(np.int64(len(x))) + 1, 2 * (bands.most(np.int64(len(x))) + 1))


def test_short_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        every = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
        a, b = every[:250], every[rng.integers(0, 60):]
        one, two = (np.frombuffer(s, dtype=np.uint8) for s in pj.short_sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
        assert np.bitwise_count(one ^ two).sum() <= len(np.setxor1d(a, b))


def test_short_sketches_of_all_sizes_fold_to_the_shorter():
    rng = np.random.default_rng(4)
    for size in (3, 90, 300, 800, 2000, 5000, 30000):
        every = np.unique(rng.integers(0, 2**63, size * 3, dtype=np.uint64))
        rng.shuffle(every)
        a, b = np.sort(every[:size * 2]), np.sort(every[size:size + size // 2])
        one, two = pj.short_sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        words = min(len(one), len(two)) // 8
        x, y = pj.folded([one, two], words)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
        alone = pj.short_sketches(b, np.array([0, len(b)]))
        assert alone == [two] and (pj.folded(alone, words) == y).all()


def test_pairs_of_large_sets_far_apart_are_not_verified(spark):
    """A key's members, half of each set in common: their pairs, the square of their number, are ruled out."""
    rng = np.random.default_rng(6)
    n, members = 2000, 40
    common = rng.integers(0, 2**63, n // 2, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, n // 2, dtype=np.uint64)])) for _ in range(members)]
    sketches = pj.short_sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    spokes = spark.createDataFrame([(1, i, 99) for i in range(members)], "key long, sid long, hub long")
    shorts = spark.createDataFrame([(i, len(s), bytearray(x)) for i, (s, x) in enumerate(zip(sets, sketches, strict=True))],
                                   "sid long, n long, short binary")
    roots = spark.createDataFrame([], "node long, root long")
    assert pj._apart(spokes, roots, shorts, pj.Bands(), 16).count() == 0
    twins = shorts.union(spark.createDataFrame([(members, len(sets[3]), bytearray(sketches[3]))], shorts.schema))
    more = spokes.union(spark.createDataFrame([(1, members, 99)], spokes.schema))
    assert [tuple(r) for r in pj._apart(more, roots, twins, pj.Bands(), 16).collect()] == [(members, 3)]


def test_large_linked_sets_meet_beside_a_hub_that_links_neither(spark):
    """Two families around one text: links within each, none to the text in the middle nor across."""
    rng = random.Random(8)
    middle = [f"m{i}" for i in range(1500)]
    rows = [(0, " ".join(middle))]
    for f in range(2):
        base = [f"f{f}-{i}" if i % 9 == f else w for i, w in enumerate(middle[:1300])] + middle[1300:]
        rows += [(1 + 10 * f + i, edited(rng, base, 12)) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = as_rows(pj.join(docs, chunk=4))
    assert got == expected(rows) and len({r[2] for r in got}) == 3


def test_sets_are_those_of_the_words():
    texts = ["A b\tC d e F", "a b c d e f", "a b", "A  B", "b a", None, " ", "a b c d e f a b c d e f"]
    hashes, offsets = pj.shingle_sets(pa.array(texts))
    sets = [set(hashes[offsets[i]:offsets[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[0] == sets[1] and sets[2] == sets[3] and sets[2] != sets[4] and sets[0] <= sets[7]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def test_equals_all_pairs_on_edited_copies(spark):
    """Copies at all distances around the limit, chains, a hub whose copies are not linked with each other."""
    rng = random.Random(5)
    rows, n = [], 0
    for size in (4, 5, 6, 8, 9, 12, 20, 40, 90, 200, 450):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            now = base
            for step in range(7):
                rows.append((n, " ".join(now)))
                rows.append((n + 1, edited(rng, base, max(1, size // 60 * step // 2))))
                now = [*now[rng.randrange(0, 2 + size // 20):], *[f"t{rng.random()}" for _ in range(rng.randrange(0, 2 + size // 20))]]
                n += 2
    hub = [f"h{i}" for i in range(150)]
    rows.append((n, " ".join(hub)))
    rows += [(n + 1 + i, edited(rng, hub, 3)) for i in range(60)]
    rows += rows[:10] + [(None, rows[3][1]), (None, "no one else")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert as_rows(pj.join(docs, chunk=16)) == expected(rows)


def test_equals_all_pairs_on_a_table(sample):  # noqa: F811
    docs, rows = sample
    assert as_rows(pj.join(docs)) == expected(rows)


def test_odd_rows(spark, odd, none):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert as_rows(pj.join(odd)) == expected(rows)
    assert pj.join(none).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert as_rows(pj.join(blank)) == [(1, 0, 1), (2, 0, 2)]

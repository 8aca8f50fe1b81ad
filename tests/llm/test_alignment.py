"""Cross-tokenizer alignment against its definition, text by text."""

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import none, odd, sample  # noqa: F401
from tokenizers import Tokenizer

from ledgerhawk.llm import alignment
from ledgerhawk.llm.dense import Mph, build_segment, segment_of

PARTS = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "\r", ";", "é", "你好", "▁", "\x1c", "<s>", "<|endoftext|>", "'s",
         "3.5", "word.", "é,", "b...", "²!", "x;\n", "end?!", " ", "　", "\U0001f389", "<0x41>", " word", "\r\n"]


def engine():
    return alignment.aligner(*alignment.default_paths())


@lru_cache(maxsize=1)
def plain_a():
    """The library that the vocabulary file is made for."""
    tokenizer = Tokenizer.from_file(alignment.default_paths()[0])
    tokenizer.encode_special_tokens = True
    return tokenizer


def by_definition(text):
    """(A ids, B ids, groups, links) from byte ranges; None without tokens."""
    e = engine()
    raw = (" " + (text or "")).encode()
    if not text:
        return None
    a, b = plain_a().encode(" " + text, add_special_tokens=False).ids, e.b.encode(text)
    if b"".join(e.bytes_a[i] for i in a) != raw or b"".join(e.bytes_b[i] for i in b) != raw:
        return None
    owners = [[k for k, i in enumerate(ids) for _ in table[i]] for ids, table in ((a, e.bytes_a), (b, e.bytes_b))]
    links = [(a[i], b[j]) for i, j in dict.fromkeys(zip(*owners, strict=True))]  # they overlap if they share a byte
    ends = [set(np.cumsum([len(table[i]) for i in ids]).tolist()) for ids, table in ((a, e.bytes_a), (b, e.bytes_b))]
    groups, lo = [], 0
    for end in sorted(ends[0] & ends[1]):
        own = [list(dict.fromkeys(owner[lo:end])) for owner in owners]
        groups.append("|".join(",".join(str(ids[k]) for k in ks) for ids, ks in zip((a, b), own, strict=True)))
        lo = end
    return a, b, groups, links


def expected(rows):
    found = [(i, by_definition(t)) for i, t in rows]
    docs = Counter(p for _, f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = f
            out.append((i, len(a), len(b), len(groups), len(links), sum(docs[p] == best[p[0]] for p in links),
                        sum(docs[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=6))
def test_words_make_up_the_text(texts):
    numbers, offsets = engine().texts(pa.array(texts, pa.string()))
    pool = engine().pool
    for i, text in enumerate(texts):
        own = numbers[offsets[i]:offsets[i + 1]]
        f = by_definition(text)
        if f is None:
            assert len(own) == 0
        else:
            assert pool.rows[own, :4].sum(axis=0).tolist() == [len(f[0]), len(f[1]), len(f[2]), len(f[3])]
            assert b";".join(pool.texts(own)).decode() == ";".join(f[2])
            assert [(int(x) >> 15, int(x) & 32767) for x in pool.links(own)[0]] == f[3]


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**31 - 1), max_size=400), st.integers(1, 4))
def test_hash_is_minimal_perfect_and_verified(keys, segments):
    keys = np.array(sorted(keys), dtype=np.uint32)
    of = segment_of(keys, segments)
    built = [build_segment(keys[of == s]) for s in range(segments)]
    mph = Mph(segments, list(range(segments)), *(list(x) for x in zip(*built, strict=True)))
    slots = mph.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert (mph.keys[slots] == keys).all()
    other = np.setdiff1d(np.arange(2000, dtype=np.uint32), keys)
    assert (mph.slots(other) == -1).all()


def test_equals_definition_on_a_table(sample):  # noqa: F811
    docs, rows = sample
    assert as_rows(alignment.align(docs)) == expected(rows)


def test_several_tables_add_up(sample):  # noqa: F811
    """More pairs than one broadcast table may hold: several passes, the same result."""
    docs, rows = sample
    small = alignment.SEGMENT
    try:
        alignment.SEGMENT = 2048
        assert as_rows(alignment.align(docs, pairs=8192)) == expected(rows)
    finally:
        alignment.SEGMENT = small


def test_odd_rows(spark, odd, none):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert as_rows(alignment.align(odd)) == expected(rows)
    assert alignment.align(none).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert as_rows(alignment.align(blank)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

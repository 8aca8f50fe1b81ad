"""op1, op4, op5: exact against the libraries, and lossless."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import none, odd, sample  # noqa: F401
from ledgerhawk.llm import bytebpe, packing, queries, simple8b
from ledgerhawk.llm.common import shared_folder
from ledgerhawk.llm.subword import encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def words():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


TEXT = st.text(st.sampled_from(list("abAB .,'\n\t12!é́  \x1c你İΣ<|>")) | st.characters(
    exclude_categories=["Cs", "Cn"]), max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_word_encoder_equals_the_library(text):
    import pyarrow as pa
    enc = encoder(WORDS)
    ids, bounds = enc.encode(pa.array([text, None, text]))
    exp = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == exp + exp and bounds.tolist() == [0, len(exp), len(exp), 2 * len(exp)]


def test_words_before_punctuation_are_encoded_once():
    """Only the punctuation itself goes through the whole tokenizer; the word before it is known or plain."""
    import pyarrow as pa
    from ledgerhawk.llm.subword import WordEncoder
    enc, slow = WordEncoder(WORDS), []
    whole = enc.tokenizer

    class Counted:
        def encode_batch(self, part, **options):
            slow.extend(part)
            return whole.encode_batch(part, **options)

    enc.tokenizer = Counted()
    text = "stone### stone,*** \u00e9p\u00e9e&&& stone <|stone|> stone- it's- a\u0301++ x'"
    got = enc.encode(pa.array([text]))[0].tolist()
    assert got == whole.encode(text, add_special_tokens=False).ids
    assert not {w for w in slow if w.startswith(("stone", "\u00e9p\u00e9e"))} and "###" in slow


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 70_000), st.integers(0, 2**64 - 1)), min_size=1, max_size=300),
       st.sampled_from([1, 5, 64, 4096]))
def test_each_word_holds_as_many_ids_as_fit(ids, block):
    """Against a greedy packer, place by place."""
    expected, at = [], 0
    while at < len(ids):
        end = min(len(ids), (at // block + 1) * block)
        for n, bits in [*simple8b.SELECTORS, (1, 64)]:
            if all(i < 1 << bits for i in ids[at:min(end, at + n)]):
                break
        expected.append(at)
        at = min(end, at + n)
    words, first, escapes = simple8b.pack_words(np.array(ids, dtype=np.uint64), block)
    assert len(words) == len(expected) and escapes.tolist() == [i for i in ids if i >= 1 << 60]
    assert first.tolist() == [expected.index(k) for k in range(0, len(ids), block)]
    assert simple8b.unpack_words(words, first, escapes, len(ids), block).tolist() == ids


def test_special_tokens_in_a_text_are_ordinary_text():
    import pyarrow as pa
    plain = Tokenizer.from_file(WORDS)  # unmodified
    for text, same in (("It's 3.5 of a | <b> text", True), ("a <|endoftext|> b", False), ("<|startoftext|>", False)):
        ids = encoder(WORDS).encode(pa.array([text]))[0].tolist()
        assert (ids == plain.encode(text, add_special_tokens=False).ids) == same
        assert not set(ids) & {plain.token_to_id("<|endoftext|>"), plain.token_to_id("<|startoftext|>")}


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(1, 12), st.integers(1, 12))
def test_stitching_equals_one_scan(text, step, overlap):
    bpe = bytebpe.codec(RANKS)
    chunks = [text[i:i + step + overlap] for i in range(0, max(len(text) - overlap, 1), step)]
    assert bytebpe.stitch(bpe, chunks, [bytebpe.chunk_ends(bpe, c) for c in chunks], step) == bpe.scan(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63) | st.integers(0, 70_000) | st.integers(0, 3), max_size=400),
       st.sampled_from([1, 16, 64, 4096]))
def test_simple8b_round_trip(ids, block):
    a = np.array(ids, dtype=np.uint64)
    words, places, escapes = simple8b.pack_words(a, block)
    assert simple8b.unpack_words(words, places, escapes, len(a), block).tolist() == ids


def test_simple8b_block_decodes_alone():
    a = np.arange(10_000, dtype=np.uint64) * 7
    words, places, escapes = simple8b.pack_words(a, 1024)
    got = simple8b.unpack_words(words[places[3]:places[4]], np.array([0]), escapes, 1024, 1024)
    assert got.tolist() == a[3072:4096].tolist()


def expected_rows(rows, encode, end):
    return {d: np.array(encode(t) + [end], dtype="<u4") for d, t in rows}


def test_op1_every_id_once_and_gapless(spark, sample, words):
    docs, rows = sample
    got = queries.op1_packing(spark, "/root/testdata/sf0.001").toPandas()
    ids = expected_rows(rows, words, 1)
    assert set(got.doc_id) == set(ids)
    for d, pieces in got.groupby("doc_id"):
        at = 0
        for p in pieces.sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids[d])
            assert p.ids_crc32 == zlib.crc32(ids[d][at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids[d])
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 2048
    used = packing.padding(spark.createDataFrame(got)).first()
    assert used.padded < 0.02 * used.ids + 2048


def test_first_fit_decreasing_equals_the_plain_rule():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 2049, 500))[::-1]
    room, bins = [], []
    for n in lengths.tolist():
        i = next((i for i, r in enumerate(room) if r >= n), len(room))
        room += [2048] * (i == len(room))
        room[i] -= n
        bins.append(i)
    got, offsets = packing.first_fit_decreasing(lengths, 2048)
    assert got.tolist() == bins and (offsets + lengths).max() <= 2048


def test_op4_equals_tiktoken(spark, sample, ranks):
    docs, rows = sample
    for chunk, overlap in ((bytebpe.CHUNK, bytebpe.OVERLAP), (300, 20)):
        got = bytebpe.digests(bytebpe.encode(docs, chunk=chunk, overlap=overlap)).toPandas()
        exp = {}
        for d, t in rows:
            ids = ranks.encode_ordinary(t or "")
            exp[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                      hashlib.sha256((t or "").encode()).hexdigest())
        assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.itertuples()} == exp


def test_op5_files(spark, sample, words):
    docs, rows = sample
    path = shared_folder(spark)
    simple8b.write_files(docs, path)
    got = simple8b.documents(simple8b.read_files(spark, path)).toPandas().sort_values("doc_id")
    at = 0
    for r, (d, t) in zip(got.itertuples(), sorted(rows), strict=True):
        ids = np.array(words(t) + [2], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_odd_rows(spark, odd, none, words, ranks):
    n = odd.count()
    packed = packing.pack(odd).toPandas()
    assert packed[packed.start == 0].shape[0] == n
    path = shared_folder(spark)
    simple8b.write_files(odd, path)
    files = simple8b.documents(simple8b.read_files(spark, path)).toPandas()
    assert len(files) == n and files.start.min() == 0
    by_id = {r.doc_id: r.text for r in odd.collect()}
    for r in files[files.doc_id.notna()].itertuples():
        ids = np.array(words(by_id[int(r.doc_id)]) + [2], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes())
    for r in bytebpe.digests(bytebpe.encode(odd)).collect():
        assert r.n_tokens == len(ranks.encode_ordinary(by_id[r.doc_id] or ""))
    path = shared_folder(spark)
    simple8b.write_files(none, path)
    assert simple8b.documents(simple8b.read_files(spark, path)).count() == 0
    assert packing.pack(none).count() == 0 and bytebpe.encode(none).count() == 0


def test_decode_returns_the_bytes(spark, odd):
    data = {r.doc_id: bytes(r.data) for r in bytebpe.decode(bytebpe.encode(odd)).collect()}
    assert data == {r.doc_id: (r.text or "").encode() for r in odd.collect()}

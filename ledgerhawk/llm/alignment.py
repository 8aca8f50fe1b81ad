"""Cross-tokenizer alignment: how the tokens of two vocabularies cover the same bytes.

A text is encoded by both vocabularies. Byte offsets where tokens of both end cut it
into groups; tokens whose byte ranges overlap are linked. Between two neighbouring
ends (of either side) lies exactly one link, so all of it comes from merging two sorted
lists of ends.

1. First pass: every document's distinct linked id pairs, counted per slice.
2. The distinct pairs get a minimal perfect hash, built segment by segment
   (:mod:`dense`). Each task turns its counts into dense vectors indexed by that hash,
   and a tree of sums adds them up. The highest count of each A id follows.
3. Second pass: documents are aligned again and their pairs' counts looked up in the
   broadcast table of hash, keys (to verify) and counts. A table holds at most
   ``PAIRS`` pairs; more pairs are looked up by several passes, which add up.

Neither vocabulary joins characters across the start of a run of white space that
begins with a space or a line feed, nor a letter and the punctuation behind it (checked when the files are loaded), so a text's tokens are those of its words one after
the other. A worker aligns each distinct word of a slice once (a bounded memo saves it
across slices) and gathers with numpy. Texts in which that does not hold (other white
space, two spaces) are cut more carefully, and a text with a word that does not come
back byte by byte is encoded whole.

Defined cases: NULL, empty texts and texts that one side does not reproduce byte by
byte have no tokens: zeros and an empty digest. Repeated rows count as documents of their
own, one row comes back for each input row, in no order; an empty table gives an empty
result; extra columns are ignored. Special tokens' strings in a text are plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, prepared, text_groups
from .dense import SEGMENT, Mph, build_segment, distinct, mixed, segment_of, tree_sum, vectors

#: Distinct words a worker remembers, and words it encodes in one call.
MEMO_WORDS, CALL_WORDS = 150_000, 4096
#: Text bytes aligned at a time: a slice's words are all in memory, remembered or not.
SLICE = 4 << 20
#: Pairs in one broadcast table (12 bytes each and 3 bits).
PAIRS = 8_000_000
#: Pair counts that a task holds before it passes them on.
HELD_PAIRS = 1_000_000

_CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: Punctuation that both sides part from a letter before it.
_TAIL = ".,;:!?"
COLUMNS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable letter: itself if it is one, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _encoder(spec: dict, path: str, table: list[bytes]):
    """``text -> ids`` of a byte-level BPE. If ids are in the order of the merges (as ranks), the same
    vocabulary and merges run in the faster library; special tokens are plain text either way."""
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    vocab, special = spec["model"]["vocab"], {t["id"] for t in spec["added_tokens"]}
    plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if plain and all(vocab[x + y] == 256 + i for i, (x, y) in enumerate(merges)):
        import public_tokenizers
        import tiktoken

        ranks = {b: i for i, b in enumerate(table) if i not in special}
        return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


class Pool:
    """Aligned words by number: counts, the pairs of their links and their groups as text, in growing flat arrays.
    Number 0 is a word that a side does not reproduce."""

    def __init__(self):
        #: n_a, n_b, n_groups, n_links, end of its pairs, end of its text
        self.rows = np.zeros((1 << 12, 6), dtype=np.int64)
        self.pairs = np.zeros(1 << 14, dtype=np.uint32)
        self.text = bytearray()
        self.n, self.n_pairs = 1, 0

    def add(self, counts: np.ndarray, pairs: np.ndarray, sizes: np.ndarray, text: bytes) -> np.ndarray:
        """Rows (n_a, n_b, n_groups, n_links), their pairs and text one after the other; returns their numbers."""
        m = len(counts)
        while self.n + m > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        while self.n_pairs + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        new = self.rows[self.n:self.n + m]
        new[:, :4] = counts
        new[:, 4] = self.n_pairs + np.cumsum(counts[:, 3])
        new[:, 5] = len(self.text) + np.cumsum(sizes)
        self.pairs[self.n_pairs:self.n_pairs + len(pairs)] = pairs
        self.text += text
        self.n, self.n_pairs = self.n + m, self.n_pairs + len(pairs)
        return np.arange(self.n - m, self.n)

    def texts(self, numbers: np.ndarray) -> list[bytes]:
        lo, hi = self.rows[np.maximum(numbers - 1, 0), 5].tolist(), self.rows[numbers, 5].tolist()
        return [bytes(self.text[x:y]) for x, y in zip(lo, hi, strict=True)]

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' pairs one after the other, and each one's place in ``numbers``."""
        n = self.rows[numbers, 3]
        starts = self.rows[numbers, 4] - n
        place = np.repeat(np.arange(len(numbers)), n)
        return self.pairs[np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)], place


class Aligner:
    def __init__(self, path_a: str, path_b: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.ids_a = _encoder(spec, path_a, self.bytes_a)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.space = self.b.piece_to_id("▁")
        # a separator and the decimal id, left-aligned, as bytes
        ids = np.char.mod(" %d", np.arange(max(len(self.bytes_a), len(self.bytes_b)))).astype("S")
        self.digits = ids.view(np.uint8).reshape(len(ids), -1)
        self.n_digits = np.char.str_len(ids)
        #: Characters before which a word may be cut off: no piece of B holds them behind another character.
        self.safe = {c for c, mark in ((" ", "▁"), ("\n", "\n"))
                     if not any(mark in p.lstrip("▁") for p in pieces)} - ({"\n"} if any("\n" in p for p in pieces) else set())
        #: Whether no piece of B joins a letter and the punctuation mark behind it.
        self.parts_tails = not any(x.isalpha() and y in _TAIL for p in pieces for x, y in zip(p, p[1:], strict=False))
        self.memo: dict[str, int] = {}
        self.pool = Pool()
        self.memo_words = memo_words

    # ------------------------------------------------------------ words

    def align(self, raw: bytes, a: list[int], b: list[int]) -> int:
        """The number of the alignment of ``raw``; 0 if a side's tokens do not spell it."""
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return 0
        return int(self._merged(np.array(a), np.array(b), np.array([len(raw)]), np.ones(1, dtype=bool))[0])

    def _merged(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray, fits: np.ndarray) -> np.ndarray:
        """Numbers of the words that end at the byte offsets ``ends`` and fit both sides' tokens."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        every = distinct(np.concatenate([ends_a, ends_b]))  # a link between any two neighbours
        at_a, at_b = np.searchsorted(ends_a, every), np.searchsorted(ends_b, every)
        pairs = (a[at_a] << 15 | b[at_b]).astype(np.uint32)
        closes = (ends_a[at_a] == every) & (ends_b[at_b] == every)
        word = np.searchsorted(ends, every)
        groups = every[closes]
        n = len(ends)
        word_a, word_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        counts = np.column_stack([np.bincount(word_a, minlength=n), np.bincount(word_b, minlength=n),
                                  np.bincount(word[closes], minlength=n), np.bincount(word, minlength=n)])
        # groups as text: A ids then B ids; ; between groups, | before the first B id, else a comma
        group = np.concatenate([np.searchsorted(groups, ends_a), np.searchsorted(groups, ends_b)])
        side = np.concatenate([np.zeros(len(a), dtype=np.int8), np.ones(len(b), dtype=np.int8)])
        order = np.lexsort((side, group))  # stable: ids stay in order
        ids, group, side = np.concatenate([a, b])[order], group[order], side[order]
        of = np.concatenate([word_a, word_b])[order]
        first = np.concatenate([[True], (group[1:] != group[:-1]) | (side[1:] != side[:-1])])
        mark = np.where(~first, ord(","), np.where(side == 1, ord("|"), ord(";"))).astype(np.uint8)
        letters, size = self.digits[ids], self.n_digits[ids].copy()
        letters[:, 0] = mark
        shown = np.arange(letters.shape[1]) < size[:, None]
        leads = np.concatenate([[True], of[1:] != of[:-1]])  # a word's text begins without a separator
        shown[leads, 0] = False
        shown &= fits[of][:, None]
        sizes = np.bincount(of, weights=shown.sum(axis=1), minlength=n).astype(np.int64)
        out = np.zeros(n, dtype=np.int64)
        out[fits] = self.pool.add(counts[fits], pairs[fits[word]], sizes[fits], letters[shown].tobytes())
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """Each word's number in the pool; a word starts with a space or line feed."""
        memo = self.memo
        new = [w for w in dict.fromkeys(words) if w not in memo]
        simple = [w for w in new if len(w) > 1 and w[0] in self.safe and len(w.split()) == 1 and not w[-1].isspace()
                  and not w[1].isspace()]
        for k in range(0, len(simple), CALL_WORDS):
            self._together(simple[k:k + CALL_WORDS])
        for w in new:
            if w not in memo:
                memo[w] = self.align(w.encode(), *self._ids(w)) if w[0] in self.safe or w[0] in _TAIL else 0
        return np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words))

    def _ids(self, word: str) -> tuple[list[int], list[int]]:
        """Both sides' ids of a word that starts with a space or line feed, as inside a text."""
        if word[0] == " ":
            return self.ids_a(word), self.b.encode(word[1:]) or [self.space]
        if word[0] in _TAIL:  # behind a letter
            letter = self.b.encode("a")
            b = self.b.encode("a" + word)
            return self.ids_a(word), b[len(letter):] if b[:len(letter)] == letter else []
        b = self.b.encode(word)
        return self.ids_a(word), b[1:] if b[:1] == [self.space] else []

    def _together(self, words: list[str]) -> None:
        """Encodes many words in one call and cuts the ids at their ends; what does not fit is left."""
        text = "".join([" x", *words])  # starts with a space whatever comes first
        a, b = self.ids_a(text), self.b.encode(text[1:])
        raw = text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return
        a, b = np.array(a), np.array(b)
        ends = np.cumsum([2, *(map(len, words) if len(raw) == len(text) else (len(w.encode()) for w in words))])
        known = np.isin(ends, np.cumsum(self.size_a[a])) & np.isin(ends, np.cumsum(self.size_b[b]))
        fits = known.copy()
        fits[1:] &= known[:-1]
        fits[0] = False
        numbers = self._merged(a, b, ends, fits)[1:].tolist()
        self.memo.update((w, k) for w, k in zip(words, numbers, strict=True) if k)

    # ------------------------------------------------------------ texts

    def whole(self, text: str) -> int:
        """One text by its definition."""
        if not text:
            return 0
        return self.align((" " + text).encode(), self.ids_a(" " + text), self.b.encode(text))

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(numbers, offsets)``: text ``i`` (null: empty) is made of the words
        ``numbers[offsets[i]:offsets[i+1]]`` of the pool; none if it has no tokens."""
        if len(self.memo) > self.memo_words:
            self.memo, self.pool = {}, Pool()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = np.asarray(cut.offsets, dtype=np.int64)
        flat = cut.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        codes, spelled = np.asarray(flat.indices), flat.dictionary.to_pylist()
        offsets = offsets - offsets[0]
        heads = [self._head(p) for p in spelled]
        tails = [p[len(h):] for p, h in zip(spelled, heads, strict=True)]
        numbers = self.words([h if h[:1] == "\n" else " " + h for h in heads])
        behind = np.zeros(len(spelled), dtype=np.int64)
        at = np.flatnonzero(np.array([bool(t) for t in tails], dtype=bool))
        behind[at] = self.words([tails[i] for i in at.tolist()])
        odd = np.array([not p or p[-1].isspace() for p in spelled], dtype=bool) | (numbers == 0)
        odd[at] |= behind[at] == 0
        hits = np.concatenate([[0], np.cumsum(odd[codes])]) if len(codes) else np.zeros(1, dtype=np.int64)
        redo = np.flatnonzero(hits[offsets[1:]] > hits[offsets[:-1]])
        if len(codes):  # a word, then its tail where it has one
            both = np.column_stack([numbers[codes], behind[codes]])
            kept = both > 0
            kept[:, 0] = True
            numbers, offsets = both[kept], np.concatenate([[0], np.cumsum(kept.sum(axis=1))])[offsets]
        else:
            numbers = np.zeros(0, dtype=np.int64)
        if not odd.any():
            return numbers, offsets
        parts, sizes, at = [], np.diff(offsets), 0
        for i in redo.tolist():
            parts += [numbers[offsets[at]:offsets[i]], self._careful(texts[i].as_py())]
            sizes[i], at = len(parts[-1]), i + 1
        parts.append(numbers[offsets[at]:])
        return np.concatenate(parts).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])

    def _head(self, piece: str) -> str:
        """The piece without the punctuation marks behind its last letter."""
        head = piece.rstrip(_TAIL) if self.parts_tails else piece
        return head if head[-1:].isalpha() else piece

    def _careful(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int64)
        found = self.words(_CUT.split(" " + text))
        if (found > 0).all():
            return found
        one = self.whole(text)
        return np.array([one] if one else [], dtype=np.int64)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    return Aligner(path_a, path_b)


def pair_counts(engine: Aligner, numbers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a slice and how many of its texts hold each."""
    if not len(numbers):
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    seen = distinct(docs * engine.pool.n + numbers)  # a word's pairs once a document
    pairs, place = engine.pool.links(seen % engine.pool.n)
    names = distinct(pairs)
    both = distinct((seen // engine.pool.n)[place] * len(names) + np.searchsorted(names, pairs))
    return names, np.bincount(both % len(names), minlength=len(names))


def local_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(pair, h, docs)``: partial document counts of linked pairs, ``pair`` = A id * 2^15 + B id."""

    def rows(held: dict) -> pa.RecordBatch:
        pairs = np.concatenate(held["pairs"])
        names, back = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(names), dtype=np.int64)
        np.add.at(total, back, np.concatenate(held["docs"]))
        return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(_h(names)), pa.array(total)],
                                          ["pair", "h", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine, held, n = aligner(path_a, path_b), {"pairs": [], "docs": []}, 0
        for batch in text_groups(batches, limit=SLICE):
            names, counts = pair_counts(engine, *engine.texts(batch.column("text")))
            held["pairs"].append(names)
            held["docs"].append(counts)
            n += len(names)
            if n > HELD_PAIRS:
                yield rows(held)
                held, n = {"pairs": [], "docs": []}, 0
        if n:
            yield rows(held)

    return docs.select("text").mapInArrow(run, "pair bigint, h bigint, docs bigint")


def _h(pairs: np.ndarray) -> np.ndarray:
    """What :func:`segment_of` reduces to a segment."""
    return (mixed(pairs, 77) >> np.uint64(1)).astype(np.int64)


def perfect_hash(pairs: DataFrame, segments: int) -> DataFrame:
    """``(segment, sizes, words, keys)`` of the distinct ``(pair, h)``, one row a segment."""

    def build(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("pair").to_numpy()).astype(np.uint32)
        sizes, words, slots = build_segment(keys)
        return pa.table({"segment": pa.array([table.column("segment")[0].as_py()], pa.int32()),
                         "sizes": pa.array([sizes], pa.list_(pa.int64())),
                         "words": pa.array([words.tobytes()], pa.binary()), "keys": pa.array([slots.tobytes()], pa.binary())})

    of = F.pmod("h", F.lit(segments)).cast("int")
    return pairs.select(of.alias("segment"), "pair").groupBy("segment").applyInArrow(
        build, "segment int, sizes array<bigint>, words binary, keys binary")


def _loaded(rows: list, segments: int) -> tuple:
    """Driver side: what :class:`Mph` takes, from one shard's rows in order of segments."""
    return (segments, [r.segment for r in rows], [list(r.sizes) for r in rows],
            [np.frombuffer(r.words, dtype="<u8") for r in rows], [np.frombuffer(r.keys, dtype="<u4") for r in rows])


def summed_counts(local: DataFrame, shards: list, segments: int) -> DataFrame:
    """``(segment, vec)``: every pair's document count at its slot, dense and summed as a tree."""
    sc, out = local.sparkSession.sparkContext, None
    for rows in shards:
        table = sc.broadcast(_loaded(rows, segments))
        first, last = rows[0].segment, rows[-1].segment

        def dense(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            mph, part = Mph(*table.value), TaskContext.get().partitionId()
            vec, now = None, -1
            for batch in batches:
                pairs = batch.column("pair").to_numpy().astype(np.uint32)
                of, docs = batch.column("segment").to_numpy(), batch.column("docs").to_numpy()
                slots = mph.slots(pairs)
                cuts = np.flatnonzero(np.diff(of)) + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)], strict=True):
                    if hi > lo:
                        if of[lo] != now:
                            if vec is not None:
                                yield vectors(part, {now: vec})
                            now = int(of[lo])
                            base = int(mph.base[mph.at[now]])
                            vec = np.zeros(int(mph.base[mph.at[now] + 1]) - base, dtype=np.int64)
                        np.add.at(vec, slots[lo:hi] - base, docs[lo:hi])
            if vec is not None:
                yield vectors(part, {now: vec})

        mine = local.select(F.pmod("h", F.lit(segments)).cast("int").alias("segment"), "pair", "docs") \
            .where(F.col("segment").between(first, last)).sortWithinPartitions("segment")
        one = tree_sum(mine.mapInArrow(dense, "segment int, part int, vec binary"), local.rdd.getNumPartitions())
        out = one if out is None else out.union(one)
    return out


def best_counts(counted: DataFrame) -> DataFrame:
    """``(a, best)``: each A id's highest pair count; one row an id of the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, vec in zip(batch.column("keys").to_pylist(), batch.column("vec").to_pylist(), strict=True):
                a = (np.frombuffer(keys, dtype="<u4") >> 15).astype(np.int64)
                best = np.zeros(int(a.max()) + 1, dtype=np.int64)
                np.maximum.at(best, a, np.frombuffer(vec, dtype="<i8"))
                ids = np.unique(a)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best[ids])], ["a", "best"])

    return counted.select("keys", "vec").mapInArrow(run, "a bigint, best bigint").groupBy("a").agg(F.max("best").alias("best"))


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _looked_up(engine: Aligner, texts: pa.Array, mph: Mph, counts: np.ndarray, best: np.ndarray) -> dict[str, pa.Array]:
    numbers, offsets = engine.texts(texts)
    words = distinct(numbers)
    codes = np.zeros(engine.pool.n, dtype=np.int64)
    codes[words] = np.arange(len(words))
    codes = codes[numbers]
    pairs, of = engine.pool.links(words)
    names = distinct(pairs)
    back = np.searchsorted(names, pairs)
    slots = mph.slots(names)
    known = slots >= 0
    n = np.zeros(len(names), dtype=np.int64)
    n[known] = counts[slots[known]]
    is_best = known & (n == best[(names >> 15).astype(np.int64)])
    total, top = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
    np.add.at(total, of, n[back])
    np.add.at(top, of, is_best[back].astype(np.int64))
    rows = engine.pool.rows[words]
    columns = {"n_a": rows[:, 0], "n_b": rows[:, 1], "n_groups": rows[:, 2], "n_links": rows[:, 3], "n_best": top, "count_sum": total}
    out = {c: pa.array(_per_text(v[codes], offsets)) for c, v in columns.items()}
    names_of, at, listed = engine.pool.texts(words), offsets.tolist(), codes.tolist()
    out["groups_sha256"] = pa.array([
        hashlib.sha256(b";".join(map(names_of.__getitem__, listed[lo:hi]))).hexdigest() if hi > lo else ""
        for lo, hi in zip(at, at[1:], strict=False)], pa.string())
    return out


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, pairs: int = PAIRS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``pairs``: linked id pairs in one broadcast table at most (by segments of the hash)."""
    if path_a is None or path_b is None:
        path_a, path_b = default_paths()
    spark = docs.sparkSession
    docs = prepared(docs, doc_id="bigint", text="string")
    local = keep(local_counts(docs, path_a, path_b))
    pairs_found = keep(local.select("pair", "h").distinct())
    segments = max(1, -(-pairs_found.count() // SEGMENT))
    hashed = keep(perfect_hash(pairs_found, segments))
    step = max(1, pairs // (2 * SEGMENT))  # a segment holds its expected number of keys, far from twice as many

    def shard(first: int, table: DataFrame) -> list:
        return table.where(F.col("segment").between(first, first + step - 1)).orderBy("segment").collect()

    firsts = range(0, segments, step)
    shards = [s for s in (shard(f, hashed) for f in firsts) if s]
    if not shards:  # no document has tokens
        shards, counted = [], None
    else:
        counted = keep(summed_counts(local, shards, segments).join(hashed, "segment"))
    best_rows = counted.transform(best_counts).collect() if counted is not None else []
    best = np.full(1 << 17, -1, dtype=np.int64)  # every id that fits a pair
    for r in best_rows:
        best[r.a] = r.best
    best_of = spark.sparkContext.broadcast(best)
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    now = docs
    for k, first in enumerate(firsts):
        rows = shard(first, counted) if counted is not None else []
        given = spark.sparkContext.broadcast((_loaded(rows, segments), np.concatenate(
            [np.frombuffer(r.vec, dtype="<i8") for r in rows] or [np.zeros(0, dtype="<i8")])))
        last = first + step >= segments
        fields = COLUMNS + ("" if last else ", text string")

        def look(batches: Iterator[pa.RecordBatch], given=given, last=last) -> Iterator[pa.RecordBatch]:
            engine, (table, counts) = aligner(path_a, path_b), given.value
            mph = Mph(*table)
            for batch in text_groups(batches, limit=SLICE):
                found = {"doc_id": batch.column("doc_id")} | _looked_up(engine, batch.column("text"), mph, counts, best_of.value)
                if "n_best" in batch.schema.names:
                    for c in ("n_best", "count_sum"):
                        found[c] = pc.add(found[c], batch.column(c))
                if not last:
                    found["text"] = batch.column("text")
                columns = names if last else [*names, "text"]
                yield pa.RecordBatch.from_arrays([found[c] for c in columns], columns)

        now = now.mapInArrow(look, fields)
        if not last:
            now = keep(now)
    return now

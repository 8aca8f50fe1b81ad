"""Language identification of whole, possibly mixed texts.

Training counts, per language, the hashed letter trigrams of all words of all
training documents (and the letters per script); the counts are added up by
Spark into a model of ``BUCKETS`` x languages, whatever the corpus' size.

A text is then labelled word by word. The script of a word's letters narrows the
languages it may have; each of them scores the word by its trigrams' log
probabilities; and Viterbi with a switching penalty finds the best labelling of
the whole sequence of words, so a passage in another language becomes a span of
its own and a stray foreign-looking word does not. All texts of a batch advance
together, one word per step.

``lang_pred`` is the language with most letters, ``score`` its share of the letters; a
word in a script that no language was seen in is no evidence, so its letters count
for no language, but among all letters.

A second pass over the training documents learns how well a language's own texts fit
it: a histogram per language of their mean log probability per letter. The least a
text needs (``least``) lies as far below the 1 in 1,000 worst as that below the median.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; a text
wholly in unseen scripts has the first language by name, with score 0; with nothing to
learn from every text is ``und``; ties go to the first language by name; repeated
rows are labelled alike; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import distinct_pieces, fold, prepared, text_groups

UND = "und"
BUCKETS = 1 << 16
ALPHA = 0.1
PENALTY = 12.0
#: A language is a candidate for a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.001
#: Share of a language's training documents that may fit badly, and histogram buckets a nat.
BAD_FIT, FIT_BUCKETS = 0.001, 16
#: Text bytes labelled together: the arrays per word take some 20 times as much in each worker.
GROUP_BYTES = 4 << 20

#: First code point of each script range (Unicode blocks); a range ends where the next begins.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1380, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFE0, "other"), (0x20000, "han"), (0x30000, "other"),
)
_SCRIPT_NAMES = tuple(sorted({name for _, name in SCRIPTS}))
_SCRIPT_STARTS = np.array([a for a, _ in SCRIPTS], dtype=np.uint32)
_SCRIPT_CODES = np.array([_SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@dataclass
class Pieces:
    """Distinct pieces of a batch: their letters and the trigrams of their words."""

    letters: np.ndarray  # letters per piece
    script: np.ndarray  # script of its first letter
    grams: np.ndarray  # trigram buckets, piece after piece
    starts: np.ndarray  # where each piece's trigrams begin


def _letters(piece: str) -> str:
    return piece if piece.isalpha() else "".join(filter(str.isalpha, piece))


def describe(pieces: list[str]) -> Pieces:
    words = [_letters(p) for p in pieces]
    letters = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    points = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), dtype="<u4")
    # one trigram around every letter, with the gap between words as a letter of its own
    at = np.flatnonzero(points)
    mixed = points[at - 1] * np.uint32(0x9E3779B1) ^ points[at] * np.uint32(0x85EBCA77) \
        ^ points[at + 1] * np.uint32(0xC2B2AE3D)
    grams = ((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(16)).astype(np.int64) % BUCKETS
    starts = np.cumsum(letters) - letters
    first = points[at[np.minimum(starts, len(at) - 1)]] if len(at) else np.zeros(len(words), dtype=np.uint32)
    script = _SCRIPT_CODES[np.searchsorted(_SCRIPT_STARTS, first, side="right") - 1]
    return Pieces(letters, script, grams, starts)


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # BUCKETS x languages
    allowed: np.ndarray  # scripts x languages
    least: np.ndarray  # least log probability per letter of a text in each language

    def tells(self, p: Pieces) -> np.ndarray:
        """Which pieces are evidence: words in a script that some language was seen in."""
        return (p.letters > 0) & self.allowed[p.script].any(axis=1)

    def scores(self, p: Pieces) -> np.ndarray:
        """Log probability of each piece under each language; equal where nothing tells them apart."""
        out = np.zeros((len(p.letters) + 1, len(self.langs)), dtype=np.float64)
        full = np.flatnonzero(p.letters)
        if len(full):
            for k in range(len(self.langs)):
                out[full, k] = np.add.reduceat(self.logp[p.grams, k], p.starts[full])
            barred = ~self.allowed[p.script[full]]
            barred[barred.all(axis=1)] = False
            out[full] = np.where(barred, out[full].min(axis=1, keepdims=True) - 50.0, out[full])
            known = self.allowed[p.script[full]].any(axis=1)
            out[full[~known]] = 0.0
        return out


def train(docs: DataFrame, alpha: float = ALPHA) -> Model:
    """Model from all rows of ``docs (text, lang)`` that have a language."""
    rows = prepared(docs, text="string", lang="string").where("lang is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in text_groups(batches):
            codes, pieces, offsets = distinct_pieces(batch.column("text"), pc.utf8_lower)
            p = describe(pieces)
            langs = batch.column("lang").dictionary_encode()
            lang_of_word = np.repeat(np.asarray(langs.indices), np.diff(offsets))
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                times = np.bincount(codes[lang_of_word == k], minlength=len(pieces))
                total = totals.setdefault(lang, np.zeros(BUCKETS + len(_SCRIPT_NAMES), dtype=np.int64))
                total[:BUCKETS] += np.bincount(p.grams, np.repeat(times, p.letters), BUCKETS).astype(np.int64)
                total[BUCKETS:] += np.bincount(p.script, times * p.letters, len(_SCRIPT_NAMES)).astype(np.int64)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                ["lang", "bucket", "n"])

    # at most (BUCKETS + scripts) rows per language: the model itself
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket") \
        .agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS + len(_SCRIPT_NAMES), len(langs)))
    table[counts["bucket"].to_numpy(dtype=int), np.searchsorted(langs, counts["lang"]) if langs else []] = counts["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    logp = np.log(grams + alpha) - np.log(grams.sum(axis=0) + alpha * BUCKETS)
    allowed = scripts >= np.maximum(scripts.sum(axis=0) * SCRIPT_SHARE, 1)
    model = Model(langs, logp, allowed, np.full(len(langs), -np.inf))
    if langs:
        model.least = _least(rows, model)
    return model


def _least(rows: DataFrame, model: Model) -> np.ndarray:
    """Least log probability per letter of each language, from all its training documents."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            codes, pieces, offsets = distinct_pieces(batch.column("text"), pc.utf8_lower)
            p = describe(pieces)
            told = np.where(model.tells(p), p.letters, 0)
            scores = np.where(told[:, None] > 0, model.scores(p)[:-1], 0.0)
            n, text_of = batch.num_rows, np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            own = np.searchsorted(model.langs, batch.column("lang").to_pylist())
            letters = np.bincount(text_of, told[codes], n)
            fit = np.bincount(text_of, scores[codes, own[text_of]], n)
            some = np.flatnonzero(letters)
            at = np.floor(fit[some] / letters[some] * FIT_BUCKETS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own[some].astype(np.int32)), pa.array(at)], ["lang", "at"])

    # at most a row per language and bucket, of some hundred buckets
    got = rows.mapInArrow(measure, "lang int, at int").groupBy("lang", "at").count().toPandas()
    least = np.full(len(model.langs), -np.inf)
    for k, counts in got.sort_values("at").groupby("lang"):
        upto, at = counts["count"].cumsum().to_numpy(), counts["at"].to_numpy()
        worst, median = (at[np.searchsorted(upto, share * upto[-1], side="right")] for share in (BAD_FIT, 0.5))
        least[k] = (2 * worst - median) / FIT_BUCKETS
    return least


def viterbi(scores: np.ndarray, codes: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word of every text; a change of label costs ``penalty``."""
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = offsets[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    n_lang = scores.shape[1]
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts with more than t words
    changed = np.zeros((len(codes), n_lang), dtype=bool)
    source = np.zeros(len(codes), dtype=np.int16)
    value = np.zeros((len(sizes), n_lang))
    for t in range(longest):
        k = active[t]
        at, v = starts[:k] + t, value[:k]
        if t:
            best = v.argmax(axis=1)
            floor = v[np.arange(k), best][:, None] - penalty
            changed[at], source[at] = v < floor, best
            v = np.maximum(v, floor)
        value[:k] = v + scores[codes[at]]
    state = value.argmax(axis=1) if n_lang else np.zeros(len(sizes), dtype=int)
    path = np.zeros(len(codes), dtype=np.int16)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at, s = starts[:k] + t, state[:k]
        path[at] = s
        state[:k] = np.where(changed[at, s], source[at], s)
    return path


_SPAN = "array<struct<first_word:bigint,n_words:bigint,lang:string>>"
OUT = f"doc_id long, lang_pred string, score double, n_spans int, spans {_SPAN}"


def _label(texts: pa.Array, model: Model, penalty: float) -> tuple[list, list, list, list]:
    """Language, score, spans and whether the language fits (``Model.least``) of each text."""
    codes, pieces, offsets = distinct_pieces(texts, pc.utf8_lower)
    p = describe(pieces)
    n, n_lang = len(texts), len(model.langs)
    if not n_lang:
        return [UND] * n, [0.0] * n, [[]] * n, [False] * n
    # only pieces with a letter are words; places are counted over white-space pieces
    worded = p.letters[codes] > 0
    place = np.flatnonzero(worded)
    words = codes[place]
    bounds = np.concatenate(([0], np.cumsum(worded)))[offsets]
    scores = model.scores(p)
    path = viterbi(scores, words, bounds, penalty)
    text_of = np.repeat(np.arange(n), np.diff(bounds))
    told = np.where(model.tells(p), p.letters, 0)[words]
    votes = np.bincount(text_of * n_lang + path, told, n * n_lang).reshape(n, n_lang)
    total, best = np.bincount(text_of, p.letters[words], n), votes.argmax(axis=1)
    mine = (path == best[text_of]) & (told > 0)
    fit = np.bincount(text_of[mine], scores[words[mine], path[mine]], n)
    fits = fit >= model.least[best] * np.maximum(votes[np.arange(n), best], 1)
    turns = np.ones(len(path), dtype=bool)
    turns[1:] = (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])
    first = np.flatnonzero(turns)
    last = np.append(first, len(path))[1:] - 1
    spans: list[list] = [[] for _ in range(n)]
    inside = place - offsets[text_of] if len(place) else place
    for d, a, b, k in zip(text_of[first].tolist(), inside[first].tolist(), inside[last].tolist(),
                          path[first].tolist(), strict=True):
        spans[d].append({"first_word": a, "n_words": b - a + 1, "lang": model.langs[k]})
    langs = [model.langs[k] if t else UND for k, t in zip(best.tolist(), total.tolist(), strict=True)]
    score = np.divide(votes[np.arange(n), best], total, out=np.zeros(n), where=total > 0)
    return langs, score.tolist(), spans, fits.tolist()


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """``doc_id, lang_pred, score, n_spans, spans`` of every row."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, limit=GROUP_BYTES):
            langs, score, spans, _ = _label(batch.column("text"), model, penalty)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                 pa.array(list(map(len, spans)), pa.int32()),
                 pa.array(spans, pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()),
                                                     ("lang", pa.string())])))],
                ["doc_id", "lang_pred", "score", "n_spans", "spans"])

    return prepared(docs, doc_id="bigint", text="string").mapInArrow(label, OUT)


def held_out() -> Column:
    """The fold that is never learned from."""
    return fold(4) == 2


def train_on(docs: DataFrame) -> Model:
    """Model from the documents outside the held-out fold."""
    return train(prepared(docs, doc_id="bigint", text="string", lang="string").where(~held_out()))


def with_language(docs: DataFrame, min_score: float) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is found with ``min_score`` or more and fits the text."""
    model = train_on(docs)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, limit=GROUP_BYTES):
            langs, score, _, fits = _label(batch.column("text").cast(pa.string()), model, PENALTY)
            good = [lang != UND and s >= min_score and fit
                    for lang, s, fit in zip(langs, score, fits, strict=True)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(select, T.StructType(docs.schema.fields))

"""License scan: exact phrases, and short notices with a bounded number of errors.

A text is reduced to its words, joined by single spaces. Phrases are found by
exact search at word borders. A notice may be off by up to ``errors`` characters
(insertions, deletions, replacements): it is split into ``errors + 1`` seeds, of
which one must occur unchanged (pigeonhole). All seeds of all notices are looked
up in one pass by an Aho-Corasick automaton; around every hit the ``regex``
library's bounded-error matching verifies the notice in a window of its own, as long
as the notice and its errors, and the best match's span in words and its errors are
reported. Whole texts are searched; the work grows with their length and their hits.

Defined cases: a NULL or empty text has no words and no labels; a phrase that
occurs more than once counts every place; of overlapping matches of one notice the
one with fewest errors is its span (ties: the first), and matches apart, adjacent ones too,
are spans of their own; repeated rows are scanned alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepared, text_groups

#: Phrases searched exactly, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Fixed values: (label, notice, errors allowed). Errors stay under one in ten characters.
NOTICES = (
    ("mit", "released under the mit license", 2),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 6),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", 6),
    ("apache-2", "licensed under the apache license version 2 0", 3),
    ("apache-2", "you may not use this file except in compliance with the license", 5),
    ("cc-by-nc", "licensed under cc by nc 4 0", 2),
    ("cc-by-nc", "creative commons attribution noncommercial", 4),
    ("cc-by", "creative commons attribution 4 0 international", 4),
    ("gpl", "licensed under the gnu general public license version", 4),
    ("gpl", "under the terms of the gnu general public license", 4),
    ("lgpl", "gnu lesser general public license", 3),
    ("mpl-2", "mozilla public license version 2 0", 3),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 6),
    ("bsd", "this software is provided by the copyright holders and contributors as is", 5),
)
_TABLE = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else 0x20 for b in range(256))


def normalise(text: str | None) -> str:
    """Words (digits, letters after lower-casing A-Z, everything beyond ASCII), one space apart, padded by spaces."""
    words = (text or "").encode().lower().translate(_TABLE).split(b" ")
    joined = b" ".join([w for w in words if w])
    return f" {joined.decode()} " if joined else ""


def seeds(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` parts of a notice with their places: with at most ``errors`` edits one is intact."""
    cuts = [round(len(notice) * i / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES):
        import ahocorasick
        import regex

        self.phrases, self.notices = tuple(phrases), tuple(notices)
        self.exact = [(f" {p} ", label) for p, label in self.phrases]
        self.fuzzy = [regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={errors}}}") for _, text, errors in self.notices]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, errors) in enumerate(self.notices):
            for at, seed in seeds(text, errors):
                places.setdefault(seed, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for seed, where in places.items():
            self.automaton.add_word(seed, (len(seed), where))
        self.automaton.make_automaton()

    def base(self, text: str) -> list[tuple[int, str]]:
        """``(first word, label)`` of every place of a phrase in a normalised text."""
        at, labels = [], []
        for phrase, label in self.exact:
            i = text.find(phrase)
            while i >= 0:
                at.append(i)
                labels.append(label)
                i = text.find(phrase, i + 1)
        return sorted(zip(np.searchsorted(_gaps(text), at).tolist(), labels, strict=True)) if at else []

    def matches(self, text: str) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Per notice found: its number, and ``(errors, start, end)`` of the best match around every seed hit."""
        begins: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for k, at in where:
                begins.setdefault(k, set()).add(end - size + 1 - at)
        for k, places in begins.items():
            _, notice, errors = self.notices[k]
            found = set()
            for begin in places:  # hits of one unbroken notice share their begin
                if begin >= 0 and text.startswith(notice, begin):
                    found.add((0, begin, begin + len(notice)))
                elif m := self.fuzzy[k].search(text, max(0, begin - errors), begin + len(notice) + errors):
                    found.add((sum(m.fuzzy_counts), *m.span()))
            if found:
                yield k, sorted(found)

    def spans(self, text: str) -> list[dict]:
        """Verified notices of a normalised text: label, first word, words, errors and similarity."""
        found = [(k, *m) for k, mine in self.matches(text) for m in apart(mine)]
        if not found:
            return []
        starts = np.array([a + (text[a] == " ") for _, _, a, _ in found])
        words = np.searchsorted(_gaps(text), starts) - 1
        out = [{"label": self.notices[k][0], "first_word": first, "n_words": len(text[a:b].split()), "errors": wrong,
                "similarity": 1.0 - wrong / len(self.notices[k][1])}
               for (k, wrong, a, b), first in zip(found, np.maximum(words, 0).tolist(), strict=True)]
        return sorted(out, key=lambda s: (s["first_word"], s["label"], s["errors"]))


def _gaps(text: str) -> np.ndarray:
    """Places of the spaces of a text, ascending: how many come before a place is a word's number."""
    return np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype="<u4") == 32)


def apart(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of ``(errors, start, end)``, best first, those that overlap no better one that stays."""
    width = max((b - a for _, a, b in matches), default=1)
    held: dict[int, list[tuple[int, int]]] = {}  # by start // width: an overlap is in this cell or a neighbour
    kept = []
    for wrong, a, b in matches:
        cell = a // width
        if all(b <= x or y <= a for c in (cell - 1, cell, cell + 1) for x, y in held.get(c, ())):
            held.setdefault(cell, []).append((a, b))
            kept.append((wrong, a, b))
    return kept


@lru_cache(maxsize=4)
def scanner(phrases=PHRASES, notices=NOTICES) -> Scanner:
    return Scanner(phrases, notices)


_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("errors", pa.int32()),
                   ("similarity", pa.float64())])
OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
       "score double, spans array<struct<label:string,first_word:long,n_words:long,errors:int,similarity:double>>")


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per row: places and labels of the phrases, labels and spans of the notices, and
    ``score``: 1 with a phrase, else the best notice's similarity, else 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(phrases, notices)
        for batch in text_groups(batches):
            rows = []
            for t in batch.column("text").to_pylist():
                text = normalise(t)
                base, spans = find.base(text), find.spans(text)
                labels = {x for _, x in base}
                rows.append((max(text.count(" ") - 1, 0), len(base), base[0][0] if base else None,
                             base[-1][0] if base else None, ",".join(sorted(labels)),
                             ",".join(sorted(labels | {s["label"] for s in spans})),
                             1.0 if base else max((s["similarity"] for s in spans), default=0.0), spans))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(_SPAN)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return prepared(docs, doc_id="bigint", text="string").mapInArrow(run, OUT)

"""Word-wise encoding with the public lower-casing BPE vocabulary.

The vocabulary's rules never join characters across white space, so a text's
ids are its words' ids one after the other. A worker therefore encodes each
distinct word once (with the ``tokenizers`` library) and gathers whole batches
with Arrow and numpy. The memo is bounded and only saves time: what it forgets is encoded again.
"""

from __future__ import annotations

import json
import os
import string
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import distinct_pieces

#: Words remembered by one worker (about 150 bytes each).
MEMO_WORDS = 1_000_000
#: ASCII punctuation; the apostrophe may belong to a contraction.
_TAIL = string.punctuation.replace("'", "")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """``encode(texts)`` gives all ids of the texts and each text's offsets."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        model = json.loads(spec)
        vocab = model["model"]["vocab"]
        # the same model for words that are letters, lower case and NFC already: nothing to normalise or split
        letters = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        model |= {"normalizer": None, "added_tokens": [], "post_processor": None, "pre_tokenizer": {
            "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, letters]}}
        self.plain = Tokenizer.from_str(json.dumps(model))
        self.size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(self.size, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.memo: dict[str, bytes] = {}
        self.memo_words = memo_words

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids uint32, offsets int64)``; text ``i`` (null: empty) is ``ids[offsets[i]:offsets[i+1]]``."""
        return self.encode_pieces(*distinct_pieces(texts))

    def encode_pieces(self, codes: np.ndarray, distinct: list[str],
                      offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode` of texts that :func:`distinct_pieces` has cut already."""
        _, lengths, ids, word_of_text = self.by_word(codes, distinct, offsets)
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        return ids, bounds[word_of_text]

    def by_word(self, codes: np.ndarray, distinct: list[str], offsets: np.ndarray):
        """White-space separated pieces: their codes' ids, gathered for the texts in order.

        Returns (piece codes, ids per piece, ids, offsets of each text in pieces)."""
        known = self._pieces(distinct)
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) >> 2
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes] if len(codes) else np.zeros(0, dtype=np.int64)
        total = int(lengths.sum())
        if total:
            shift = starts[codes] - (np.cumsum(lengths) - lengths)
            ids = flat[np.repeat(shift, lengths) + np.arange(total)]
        else:
            ids = np.zeros(0, dtype=np.uint32)
        return codes, lengths, ids, offsets

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        memo = self.memo
        if len(memo) > self.memo_words:
            memo.clear()
        out = list(map(memo.get, pieces))
        missing = [i for i, b in enumerate(out) if b is None]
        split, need = {}, {}
        for i in missing:
            piece = pieces[i]
            head = piece.rstrip(_TAIL)
            # letters, then ASCII punctuation: the vocabulary's pattern always parts them here
            if len(head) < len(piece) and head.isalpha():
                tail = piece[len(head):]
                split[i] = (head, tail)
                for part in (head, tail):
                    if part not in memo:
                        need[part] = None
            else:
                need[piece] = None
        if need:
            self._encode_new(list(need))
        for i in missing:
            if i in split:
                head, tail = split[i]
                memo[pieces[i]] = memo[head] + memo[tail]
            out[i] = memo[pieces[i]]
        return out

    def _encode_new(self, words: list[str]) -> None:
        plain, other = [], []
        for w in words:
            simple = w.isalpha() and w == w.lower() and unicodedata.is_normalized("NFC", w)
            (plain if simple else other).append(w)
        for k in range(0, len(plain), 200):
            part = plain[k:k + 200]
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):  # a letter the pattern treats otherwise: one by one
                other += part
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(part, (ends * 4).tolist(), strict=True):
                self.memo[w] = raw[at:end]
                at = end
        for k in range(0, len(other), 2000):
            part = other[k:k + 2000]
            for w, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                self.memo[w] = np.array(e.ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    return WordEncoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' ids with ``end_id`` after each text, and the new offsets."""
    n = len(offsets) - 1
    bounds = offsets + np.arange(n + 1)
    out = np.empty(len(ids) + n, dtype="<u4")
    is_end = np.zeros(len(out), dtype=bool)
    is_end[bounds[1:] - 1] = True
    out[is_end] = end_id
    out[~is_end] = ids
    return out, bounds

"""Token ids of whole texts by a ``tokenizers`` word-BPE file, with a bounded
word cache.

The vocabulary file splits a text into runs of letters, single digits and
runs of other marks, and encodes each piece by itself, so a piece's ids can be
kept. Texts in plain Latin characters are cut by the same rule here, many at a
time, and only unseen pieces reach the tokenizer; any other text goes to it
whole. Either way the ids are the tokenizer's own.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters, digits and marks among the Latin-1 characters, after lower-casing.
_LETTER, _DIGIT = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\\s{_LETTER}{_DIGIT}]+")
# Characters for which that rule and the tokenizer's are the same.
_PLAIN = re.compile("[\t\n\r -~¡-ÿ]*")


class WordEncoder:
    """``encode_all(texts) -> list of bytes``: the ids of each as little-endian
    unsigned 32-bit numbers (``encode``: of one text). Arrow splits texts of
    ``block`` characters at their blanks and tells the distinct chunks, which
    are cut into pieces; pieces are looked up, and new ones go to the tokenizer.
    ``cache`` bounds the entries kept (old ones go by halves): about 30 MB
    for words of six letters."""

    def __init__(self, path: str, cache: int = 200_000, block: int = 4_000_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.block = Cache(cache), block

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        plain, size = [], 0
        for i, text in enumerate(texts):
            if not _PLAIN.fullmatch(text) or any(s in text for s in self.specials):
                out[i] = self.whole(text)
                continue
            plain.append(i)
            size += len(text)
            if size >= self.block:
                self.into(out, texts, plain)
                plain, size = [], 0
        self.into(out, texts, plain)
        return out

    def into(self, out: list, texts: list[str], plain: list[int]) -> None:
        """Puts the ids of the plain texts in their places of ``out``."""
        if not plain:
            return
        chunks = pc.utf8_split_whitespace(pc.utf8_lower(pa.array([texts[i] for i in plain], pa.large_string())))
        ends = chunks.offsets.to_numpy()
        coded = chunks.flatten().dictionary_encode()
        at, ids = coded.indices.to_numpy(), self.ids_of(coded.dictionary.to_pylist())
        flat, size = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        n = size[at]
        begin = np.r_[0, np.cumsum(n)]
        tokens = flat[np.arange(begin[-1]) + np.repeat((np.cumsum(size) - size)[at] - begin[:-1], n)]
        of_text = begin[ends - ends[0]].tolist()
        for i, a, b in zip(plain, of_text, of_text[1:]):
            out[i] = tokens[a:b].tobytes()

    def ids_of(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks."""
        cut = list(map(PIECES.findall, chunks))
        unseen = self.pieces.missing(set(chain.from_iterable(cut)))
        known, model = self.pieces.new, self.tokenizer.model
        # An ASCII piece is its own normal form, which the model takes at once.
        known.update((p, array("I", [t.id for t in model.tokenize(p)]).tobytes()) for p in unseen if p.isascii())
        rest = [p for p in unseen if not p.isascii()]
        for i in range(0, len(rest), 512):
            part = rest[i:i + 512]
            known.update(zip(part, self.apart(part)))
        return [known[p[0]] if len(p) == 1 else b"".join(map(known.__getitem__, p)) for p in cut]

    def apart(self, pieces: list[str]) -> list[bytes]:
        """Each piece's ids, from one call."""
        e = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        word, raw = np.array(e.word_ids, np.int64), np.array(e.ids, "<u4").tobytes()
        at = (4 * np.flatnonzero(np.r_[True, word[1:] != word[:-1], True])).tolist() if len(word) else [0]
        if len(at) != len(pieces) + 1:             # a piece without ids, or of several words for the tokenizer
            return [self.whole(p) for p in pieces]
        return [raw[s:t] for s, t in zip(at, at[1:])]


class Cache:
    """A dictionary in two halves: when ``new`` is full, it becomes ``old``;
    what is asked for again comes back from there."""

    def __init__(self, size: int):
        self.half, self.new, self.old = size // 2, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` that must be put into ``new``; all others are there afterwards."""
        if len(self.new) > self.half:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        left = [k for k in keys if k not in new]
        new.update((k, old[k]) for k in left if k in old)
        return [k for k in left if k not in old]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)

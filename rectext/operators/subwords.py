"""M3 by subwords: text to the ids of a WordPiece vocabulary, cut to a length,
with an attention mask, as a transformer encoder takes them.

A text is cleaned (control characters out, white space to blanks, CJK
characters apart), lower-cased without accents, cut at blanks and punctuation,
and each word is matched greedily: the longest piece of the vocabulary, then
the longest continuation (``##...``), and so on; a word that can't be matched
to its end is the unknown token. Words repeat, so a worker keeps their ids.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The special tokens, and the longest word that is matched at all.
SPECIAL = {"unk": "[UNK]", "cls": "[CLS]", "sep": "[SEP]", "pad": "[PAD]"}
LONGEST_WORD = 100
#: Most tokens a vocabulary may have, as all tasks get it.
MAX_TOKENS = 1_000_000
# First and last code point of the blocks whose characters are words by themselves.
CJK = ((0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F))


def read_vocabulary(spark: SparkSession, path: str) -> list[str]:
    """A vocabulary file: one token a line, its number from 0. A file of one
    line order: it is read by one task, as it is bounded."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a vocabulary is one file")
    return checked(rows[0]["value"].split("\n")[:-1] if rows[0]["value"].endswith("\n") else rows[0]["value"].split("\n"))


def checked(vocabulary: list[str]) -> list[str]:
    if len(vocabulary) > MAX_TOKENS:
        raise ValueError(f"a vocabulary has at most {MAX_TOKENS} tokens")
    missing = [t for t in SPECIAL.values() if t not in vocabulary]
    if missing:
        raise ValueError(f"not in the vocabulary: {missing}")
    return vocabulary


def _split(c: str) -> str:
    """What a character becomes before words are cut."""
    kind = unicodedata.category(c)
    if c in "\t\n\r" or kind.startswith("Z"):
        return " "
    if c in "\0�" or kind.startswith("C"):
        return ""
    if any(a <= ord(c) <= b for a, b in CJK):
        return f" {c} "
    return c


def _apart(c: str) -> str:
    """Punctuation stands by itself: any of Unicode's, and all ASCII marks."""
    return f" {c} " if unicodedata.category(c).startswith("P") or "!" <= c <= "/" or ":" <= c <= "@" or "[" <= c <= "`" or "{" <= c <= "~" else c


class _Table(dict):
    """A translation table that is filled by a rule as characters come."""

    def __init__(self, rule):
        self.rule = rule

    def __missing__(self, point: int) -> str:
        self[point] = out = self.rule(chr(point))
        return out


class Subwords:
    def __init__(self, vocabulary: list[str], lower: bool = True, cache: int = 200_000):
        self.number = {t: i for i, t in enumerate(vocabulary)}
        self.unk, self.cls, self.sep, self.pad = (self.number[SPECIAL[k]] for k in ("unk", "cls", "sep", "pad"))
        self.longest = max(map(len, vocabulary))
        self.lower, self.cache, self.known = lower, cache, {}
        self.clean, self.marks = _Table(_split), _Table(_apart)

    def words(self, text: str) -> list[str]:
        text = text.translate(self.clean)
        if self.lower:
            if not text.isascii():
                text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
            text = text.lower()
        return text.translate(self.marks).split()

    def match(self, word: str) -> list[int]:
        """Ids of one word, longest pieces first."""
        if len(word) > LONGEST_WORD:
            return [self.unk]
        out, at = [], 0
        while at < len(word):
            for end in range(min(len(word), at + self.longest), at, -1):
                i = self.number.get(("##" if at else "") + word[at:end])
                if i is not None:
                    out.append(i)
                    at = end
                    break
            else:
                return [self.unk]
        return out

    def ids(self, text: str, most: int) -> list[int]:
        """At most ``most`` ids; words after the cut aren't matched."""
        out = []
        for w in self.words(text):
            got = self.known.get(w)
            if got is None:
                if len(self.known) >= self.cache:
                    self.known.clear()
                got = self.known[w] = self.match(w)
            out += got
            if len(out) >= most:
                return out[:most]
        return out


@lru_cache(maxsize=2)
def _subwords(vocabulary: tuple, lower: bool) -> Subwords:
    return Subwords(list(vocabulary), lower)


def subword_inputs(df: DataFrame, text: Column, vocabulary: list[str], max_length: int = 512, lower: bool = True, pad: bool = False,
                   ids: str = "input_ids", mask: str = "attention_mask") -> DataFrame:
    """``df`` with ``input_ids`` (array<int>: the class token, at most
    ``max_length - 2`` subwords, the end token) and ``attention_mask`` (ones);
    with ``pad`` both are filled up to ``max_length`` (mask 0).

    A null text has null in both, an empty one only the two special tokens.
    Columns of ``df`` named like a result are replaced. ``vocabulary`` is the
    list of tokens in the order of their numbers (``read_vocabulary``), with
    the special tokens; its size is checked, as it goes to all tasks."""
    if max_length < 2:
        raise ValueError("max_length must leave room for the two special tokens")
    sent = df.sparkSession.sparkContext.broadcast(tuple(checked(vocabulary)))

    @F.pandas_udf("array<int>")
    def cut(texts: pd.Series) -> pd.Series:
        coder = _subwords(sent.value, lower)
        return pd.Series([None if t is None else [coder.cls, *coder.ids(t, max_length - 2), coder.sep] for t in texts], dtype=object)

    out = df.withColumn(ids, cut(text.cast("string")))
    out = out.withColumn(mask, F.transform(F.col(ids), lambda _: F.lit(1)))
    if pad:
        fill = lambda c, x: F.concat(F.col(c), F.array_repeat(F.lit(x), max_length - F.size(c)))
        out = out.withColumns({mask: fill(mask, 0), ids: fill(ids, vocabulary.index(SPECIAL["pad"]))})
    return out

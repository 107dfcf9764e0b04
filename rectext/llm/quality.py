"""Quality rules by distribution divergence.

Every text is described by two histograms, its character classes and its use
of common words, and compared with the references of the languages in the
corpus by the Jensen-Shannon distance (base 2, so 0 to 1). The references are
measured over all documents: the character classes of each language, and its
common words, those that make up at least ``common_share`` of its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rectext.llm.common import arrow_schema, columns, in_batches, map_rows, parts, saved

# White space of a word (tab, \n, \v, \f, \r, space) and symbols.
WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
# Character classes; every byte that starts a character belongs to one.
CLASSES = ("white", "lower", "upper", "digit", "mark", "symbol", "control", "beyond_ascii")


def _class_of_byte() -> np.ndarray:
    """Class number of each byte; -1 for UTF-8 continuation bytes, so that
    counting bytes counts code points."""
    out = np.full(256, CLASSES.index("symbol"))
    out[:32] = out[127] = CLASSES.index("control")
    out[list(WHITE)] = CLASSES.index("white")
    out[ord("a"):ord("z") + 1] = CLASSES.index("lower")
    out[ord("A"):ord("Z") + 1] = CLASSES.index("upper")
    out[ord("0"):ord("9") + 1] = CLASSES.index("digit")
    out[list(b".,;:!?'\"()-")] = CLASSES.index("mark")
    out[0x80:0xC0] = -1
    out[0xC0:] = CLASSES.index("beyond_ascii")
    return out


@dataclass(frozen=True)
class Rules:
    """``min_words`` / ``max_repeat_percent``: the base rules.

    Distance to a language: a histogram of ``n`` things is noise of about
    1 / sqrt(n), so the limits are ``sqrt(floor ** 2 + noise ** 2 / n)`` with
    ``n`` the characters (class rule) or words (word rule); the rules need
    ``class_min_chars`` and ``word_min_words`` of them. ``common_share``: a
    common word's least share of its language's words (so at most 1 /
    common_share words a language). ``language_share``: least share of all
    words from which a language's reference judges every document; that of
    a smaller language judges its own documents only. ``max_languages``: so
    many references, by words, reach driver and tasks; documents of further
    languages pass the distance rules."""

    min_words: int = 20
    max_repeat_percent: int = 30
    class_floor: float = 0.22
    class_noise: float = 4.5
    word_floor: float = 0.2
    word_noise: float = 2.0
    class_min_chars: int = 200
    word_min_words: int = 40
    common_share: float = 0.005
    language_share: float = 0.001
    max_languages: int = 1000


def repeated_starts(ids: np.ndarray, width: int) -> np.ndarray:
    """Starts of the ``width``-word windows found twice or more (exact).

    Windows grow by doubling (``width`` is a power of two): a window of 2s
    words can only repeat where both its halves do, so each step keeps just
    the repeated ones and names them by rank."""
    counts = np.bincount(ids)
    cur = np.where(counts[ids] > 1, ids, -1).astype(np.int64)
    span, names = 1, len(counts)
    while span < width:
        m = len(ids) - 2 * span + 1
        if m < 2:
            return np.empty(0, np.int64)
        at = np.flatnonzero((cur[:m] >= 0) & (cur[span:span + m] >= 0))
        if len(at) < 2:
            return np.empty(0, np.int64)
        _, rank, n = np.unique(cur[at] * names + cur[at + span], return_inverse=True, return_counts=True)
        again = n[rank] > 1
        cur = np.full(m, -1, np.int64)
        cur[at[again]] = rank[again]
        span, names = 2 * span, len(n)
    return np.flatnonzero(cur >= 0)


def n_repeat_words(words: list, width: int = 8) -> int:
    if len(words) <= width:
        return 0
    names = dict.fromkeys(words)
    if len(names) == len(words):
        return 0
    names = dict(zip(names, range(len(names))))
    ids = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    starts = repeated_starts(ids, width)
    if not len(starts):
        return 0
    return int(width + np.minimum(np.diff(starts), width).sum())


def n_dup_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def js_distance(p: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of ``p`` to each row of ``refs``."""
    m = (p + refs) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        b = np.where(refs > 0, refs * np.log2(refs / m), 0).sum(-1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


_LETTERS = re.compile(rb"[a-z\x80-\xff]+")


def common_words_of(raw: bytes) -> Counter:
    return Counter(_LETTERS.findall(raw.lower()))


def language_references(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang",
                        flush: int = 200_000) -> list[dict]:
    """References of the languages, measured over all documents with a text
    and a language: ``{lang, classes: [share], words: [(word, share)],
    share}``, the last of all words. Every language that occurs has one, up to
    ``max_languages``.

    Each task counts in a dictionary that it empties into the shuffle at
    ``flush`` words; Spark adds up. Only shares of at least ``common_share``
    come to the driver: by that bound, not more than 1 / common_share words
    for each of ``max_languages`` languages."""
    out = arrow_schema("lang string, kind string, item binary, n long")
    class_of = _class_of_byte()

    def count(batches):
        words: dict[bytes, Counter] = {}
        classes: dict[bytes, np.ndarray] = {}

        def emptied():
            rows = [(k.decode(), "word", w, n) for k, c in words.items() for w, n in c.items()]
            rows += [(k.decode(), "class", CLASSES[i].encode(), int(n)) for k, c in classes.items() for i, n in enumerate(c)]
            words.clear()
            classes.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), out)], schema=out)

        for part in (p for batch in batches for p in parts(batch)):
            for raw, key in zip(*columns(part)):
                words.setdefault(key, Counter()).update(_LETTERS.findall(raw.lower()))
                h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
                classes.setdefault(key, np.zeros(len(CLASSES), np.int64))
                classes[key] += np.bincount(class_of[class_of >= 0], h[class_of >= 0], len(CLASSES)).astype(np.int64)
                if sum(map(len, words.values())) > flush:
                    yield emptied()
        if classes:
            yield emptied()

    known = docs.select(F.col(text), F.col(lang)).filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counted = saved(in_batches(known).mapInArrow(count, "lang string, kind string, item binary, n long")
                    .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")), "language-counts")
    everything = counted.filter("kind = 'word'").agg(F.sum("n")).first()[0] or 0
    found = (counted.groupBy("lang").agg(*[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in ("word", "class")])
             .filter("class > 0").orderBy(F.desc_nulls_last("word"), "lang").limit(rules.max_languages).collect())
    totals = {(r["lang"], k): r[k] or 0 for r in found for k in ("word", "class")}
    langs = sorted(r["lang"] for r in found)
    if not langs:
        return []
    least = F.create_map(*[F.lit(x) for k in langs for x in (k, rules.common_share * totals[k, "word"])])
    rows = counted.filter(F.col("lang").isin(langs) & ((F.col("kind") == "class") | (F.col("n") >= least[F.col("lang")]))).collect()
    refs = []
    for k in langs:
        own = {(r["kind"], bytes(r["item"])): r["n"] for r in rows if r["lang"] == k}
        refs.append({"lang": k,
                     "classes": [own.get(("class", c.encode()), 0) / max(1, totals.get((k, "class"), 1)) for c in CLASSES],
                     "words": sorted((w, n / totals[k, "word"]) for (kind, w), n in own.items() if kind == "word"),
                     "share": totals[k, "word"] / max(1, everything)})
    return refs


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, class_distance double, word_distance double, nearest_lang string")


def _arrays(references: list[dict]) -> tuple:
    """``references`` as arrays: languages, classes, vocabulary, membership, word shares."""
    vocabulary = sorted({w for r in references for w, _ in r["words"]})
    place = {w: i for i, w in enumerate(vocabulary)}
    langs = [r["lang"] for r in references]
    class_refs = np.array([r["classes"] for r in references]).reshape(len(langs), len(CLASSES))
    # Per language its own common words, and at last all others together.
    member = np.zeros((len(langs), len(vocabulary)))
    for i, r in enumerate(references):
        for w, share in r["words"]:
            member[i, place[w]] = share
    word_refs = np.hstack([member, 1 - member.sum(1, keepdims=True)]) if langs else member
    return langs, class_refs, vocabulary, member > 0, word_refs


def assessor(references: list[dict], rules: Rules = Rules()):
    """``f(raw, lang) -> `` the counts and verdict of a text (see ``quality_rules``)."""
    class_of = _class_of_byte()
    everyone = _arrays([r for r in references if r["share"] >= rules.language_share])
    small = {r["lang"]: _arrays([r]) for r in references if r["share"] < rules.language_share}
    known = {r["lang"] for r in references}
    white, symbol = np.zeros(256, bool), np.zeros(256, bool)
    white[list(WHITE)] = symbol[list(SYMBOLS)] = True

    def distances(group: tuple, h: np.ndarray, points: int, letters: Counter, total: int) -> tuple:
        """``(sum, class distance, word distance, lang)`` of the nearest language."""
        langs, class_refs, vocabulary, is_member, word_refs = group
        scores, class_d, word_d = np.zeros(len(langs)), None, None
        if points >= rules.class_min_chars:
            p = np.bincount(class_of[class_of >= 0], h[class_of >= 0], len(CLASSES)) / points
            scores += (class_d := js_distance(p, class_refs))
        if total >= rules.word_min_words:
            q = np.array([letters.get(w, 0) for w in vocabulary]) / total * is_member
            scores += (word_d := js_distance(np.hstack([q, 1 - q.sum(1, keepdims=True)]), word_refs))
        best = int(np.argmin(scores))
        return float(scores[best]), *(None if d is None else float(d[best]) for d in (class_d, word_d)), langs[best]

    def one(raw: bytes | None, lang: str | None = None) -> tuple:
        raw = raw or b""
        h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        points = int(h[class_of >= 0].sum())
        words = raw.split()
        n, repeats = len(words), n_repeat_words(words)
        failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
        dc = dw = nearest = None
        near = True
        groups = [g for g in (everyone, small.get(lang)) if g and g[0]]
        if groups and (lang is None or lang in known):
            letters = common_words_of(raw)
            total = max(n, sum(letters.values()))  # tokens without a letter are words that are not common
            _, dc, dw, nearest = min((distances(g, h, points, letters, total) for g in groups), key=lambda d: d[0])
            near = ((dc is None or dc <= np.hypot(rules.class_floor, rules.class_noise / np.sqrt(points)))
                    and (dw is None or dw <= np.hypot(rules.word_floor, rules.word_noise / np.sqrt(total))))
        return (n, points - int(h[white].sum()), int(h[symbol].sum()), n_dup_lines(raw), repeats, failed, bool(near and not failed), dc, dw, nearest)

    return one


def quality_rules(docs: DataFrame, references: list[dict], rules: Rules = Rules(), doc_id: str = "doc_id",
                  text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: word, symbol and repetition counts of the whole
    text, the base rules' verdict and ``kept``.

    A document is kept if the base rules pass and the nearest language is
    within both distances; a distance is null where its guard says that the
    text is too short, or without any reference (of all or of the document's
    language, the column ``lang`` if there is one), and then doesn't reject. A
    null or empty text has no words (all counts 0, ``base_failed``). Equal
    rows give equal rows; a null id stays null; further columns of ``docs``
    are not read."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def start():
        one = assessor(references, rules)
        return lambda ids, texts, langs: dict(zip(names, [ids, *zip(*(one(t, k and k.decode()) for t, k in zip(texts, langs)))]))

    own = F.col(lang) if lang in docs.columns else F.lit(None)
    return map_rows(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"), own.cast("string")), SCHEMA, start)


def passes(text, references: list[dict], rules: Rules = Rules(), lang=None):
    """The verdict as a column, for filters that keep a table's own columns."""
    @F.arrow_udf("boolean")
    def verdict(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        one = assessor(references, rules)
        for texts, langs in batches:
            rows = (row for part in parts(pa.RecordBatch.from_arrays([texts, langs], ["text", "lang"])) for row in zip(*columns(part)))
            yield pa.array([one(t, None if k is None else k.decode())[6] for t, k in rows], pa.bool_())

    return verdict(text, (F.lit(None) if lang is None else lang).cast("string"))


def good_documents(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, judged by references measured over
    ``docs`` themselves (see ``quality_rules``).

    Null and empty texts have too few words and go, whole texts of any length
    are read; repeated rows stay or go together; a null language is judged by
    all references. Columns stay as they are, whatever their names; an empty
    table stays empty."""
    return docs.filter(passes(F.col(f"`{text}`"), language_references(docs, rules, text, lang), rules, F.col(f"`{lang}`")))

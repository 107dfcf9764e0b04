"""Line dedup by content-defined chunks.

A text's units are its sentences and lines; a long one is cut further, after
words that their own hash chooses. A rolling hash over the hashes of
neighbouring units chooses the boundaries of chunks, so a passage has the same
chunks, but for its ends, wherever it stands. Chunks alone can't find a
passage of few units, as no whole chunk may lie inside it; so the shortest run
that counts from each unit on (mostly a pair of neighbours) is a seed as well.
A run counts if it has ``min_words`` words and two units, or is one unit of
``long_line`` words.

Seeds that occur again anywhere in the corpus are joined to their first place.
Neighbouring seeds with one and the same first text become a span, spans are
compared byte by byte, lengthened unit by unit while the bytes agree, and
removed. A seed's first place is never removed for that seed's sake.
"""

from __future__ import annotations

import math
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rectext.llm.common import arrow_schema, in_batches, saved


@dataclass(frozen=True)
class Chunking:
    """``long_line``: words from which a unit is cut further, after one word
    of ``cut_every`` on average. ``min_words``: runs of fewer words are left
    alone (so are single units of less than ``long_line`` words). ``window``:
    units that the rolling hash covers; a boundary stands where it is least
    among its ``reach`` neighbours on either side."""

    long_line: int = 40
    min_words: int = 12
    cut_every: int = 4
    window: int = 2
    reach: int = 1


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_STOP = np.isin(np.arange(256), [ord(c) for c in ".!?"])
# Fixed value: an odd factor of the rolling hash.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_hash(a: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's length, first, middle and last bytes: enough to
    choose cuts by, as equal words have equal ones."""
    h = (end - start).astype(np.uint64)
    for at in (start, (start + end) // 2, end - 1, np.minimum(start + 1, end - 1)):
        h = (h ^ a[at]) * _FACTOR
        h ^= h >> np.uint64(32)
    return h


def all_units(raws: list[bytes], how: Chunking) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of several texts: the texts joined by line ends, and of each unit
    its start and end there, its words and the number of its text. White space
    between units belongs to none."""
    joined = b"\n".join(raws) + b"\n"
    a = np.frombuffer(joined, np.uint8)
    space = _SPACE[a]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    edge = edge if space[0] else np.r_[0, edge]
    start, end = edge[::2], edge[1::2]             # of words
    if not len(start):
        return joined, *(np.zeros(0, np.int64) for _ in range(4))
    line = np.searchsorted(np.flatnonzero(a == 10), start)         # lines before
    last = _STOP[a[end - 1]] | np.r_[line[1:] != line[:-1], True]  # the word ends its unit

    def sizes(last):
        at = np.flatnonzero(last)
        return at, np.diff(np.r_[-1, at])

    at, n = sizes(last)
    if (n >= how.long_line).any():
        word = np.flatnonzero(np.repeat(n >= how.long_line, n))
        last[word] |= word_hash(a, start[word], end[word]) % np.uint64(how.cut_every) == 0
        at, n = sizes(last)
    base = np.cumsum([0, *(len(r) + 1 for r in raws)])
    return joined, start[at - n + 1], end[at], n, np.searchsorted(base, start[at], "right") - 1


def units(raw: bytes, how: Chunking, digest=None) -> list[tuple[int, int, int]]:
    """``(start, end, words)`` of all units of one text."""
    _, start, end, n, _ = all_units([raw], how)
    return list(zip(start.tolist(), end.tolist(), n.tolist()))


def chunk_starts(hashes: np.ndarray, text: np.ndarray, how: Chunking) -> np.ndarray:
    """Whether a chunk begins with each unit: at a text's first unit, and
    where the rolling hash over the last ``window`` units is least among its neighbours."""
    n = len(hashes)
    roll = np.zeros(n, np.uint64)
    for i in range(how.window):                    # unit j and the window - 1 before it
        power = np.uint64(pow(int(_FACTOR), i + 1, 1 << 64))
        roll[i:] += hashes[:n - i] * power
    roll ^= roll >> np.uint64(29)
    roll *= _FACTOR
    least = np.ones(n, bool)
    for i in range(1, how.reach + 1):
        least[i:] &= (roll[i:] < roll[:-i]) | (text[i:] != text[:-i])
        least[:-i] &= (roll[:-i] <= roll[i:]) | (text[i:] != text[:-i])
    first = np.r_[True, text[1:] != text[:-1]]
    full = np.r_[np.zeros(how.window - 1, bool), text[how.window - 1:] == text[:n - how.window + 1]] if n >= how.window else np.zeros(n, bool)
    return first | least & full


def seeds(raws: list[bytes], how: Chunking, digest) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, end, hash)`` of all seeds, sorted by text and start
    (bytes within the text): chunks of two units or more, and from each unit
    the shortest run that counts."""
    joined, s, e, n, text = all_units(raws, how)
    m = len(s)
    if not m:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    total = np.r_[0, np.cumsum(n)]                 # words before each unit
    last = np.maximum(np.arange(m) + 1, np.searchsorted(total[1:], total[:-1] + how.min_words))
    last = np.where(n >= how.long_line, np.arange(m), last)
    run = np.flatnonzero(last < m)
    run = run[text[last[run]] == text[run]]
    view = memoryview(joined)
    hashes = np.array([digest(view[i:j]) for i, j in zip(s.tolist(), e.tolist())], np.uint64)
    begin = np.flatnonzero(chunk_starts(hashes, text, how))
    close = np.r_[begin[1:], m] - 1
    chunk = (close > begin) & (total[close + 1] - total[begin] >= how.min_words)
    pairs = np.unique(np.r_[run * (m + 1) + last[run], begin[chunk] * (m + 1) + close[chunk]])
    i, j = pairs // (m + 1), pairs % (m + 1)
    base = np.cumsum([0, *(len(r) + 1 for r in raws)])[text[i]]
    h = np.array([digest(view[x:y]) for x, y in zip(s[i].tolist(), e[j].tolist())], np.uint64).view(np.int64)
    return text[i], s[i] - base, e[j] - base, h


# A null id counts as the largest number.
_LAST = (1 << 63) - 1


def _key(doc_id: str, text: str) -> list:
    """A row is told by its id and a hash of its text, so equal rows are one document."""
    return [F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_LAST)).alias("_id"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("_key")]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``_id, _key, row``: the row travels as one struct."""
    row = F.struct(*[(F.col(f"`{c}`").cast("string") if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns])
    return docs.select(*_key(doc_id, text), row.alias("row"))


def found_seeds(docs: DataFrame, how: Chunking, doc_id: str, text: str, block: int = 1 << 22) -> DataFrame:
    """``_id, _key, hash, start, end``: arrays, one row a text that has a seed."""
    ddl = "_id long, _key long, hash array<long>, start array<int>, end array<int>"
    schema = arrow_schema(ddl)

    def run(batches):
        import xxhash

        def rows(ids, keys, raws):
            at, start, end, h = seeds(raws, how, xxhash.xxh3_64_intdigest)
            has, first = np.unique(at, return_index=True)
            cut = np.r_[first, len(at)].astype(np.int32)
            lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (h, start.astype(np.int32), end.astype(np.int32))]
            return pa.RecordBatch.from_arrays([pa.array([ids[i] for i in has], pa.int64()), pa.array([keys[i] for i in has], pa.int64()),
                                               *[x.cast(f.type) for x, f in zip(lists, list(schema)[2:])]], schema=schema)

        for batch in batches:
            ids, keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary())
            a = size = 0
            for b in range(batch.num_rows):        # blocks of bounded size
                size += len(texts[b].as_buffer() or b"") if texts[b].is_valid else 0
                if size > block or b == batch.num_rows - 1:
                    yield rows(ids[a:b + 1], keys[a:b + 1], [t or b"" for t in texts.slice(a, b + 1 - a).to_pylist()])
                    a, size = b + 1, 0

    return in_batches(docs.select(*_key(doc_id, text), F.col(f"`{text}`").cast("string").alias("t"))).mapInArrow(run, ddl)


def repeated_seeds(found: DataFrame) -> DataFrame:
    """``_id, _key, start, end, ref_id, ref_key, ref_start``: seeds that
    stand elsewhere first, with that place: of all the one with the smallest
    id (null last), key and start."""
    every = found.select("_id", "_key", F.inline(F.arrays_zip("hash", "start", "end")))
    # Numbers only, which Spark adds up in place; the first place of an id follows from the few rows that are left.
    # The hint: one small row a hash to look up, instead of sorting all seeds.
    again = saved(every.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("least")).filter("n > 1").select("hash", "least"), "line-again")
    left = saved(every.join(again.hint("shuffle_hash"), "hash"), "line-repeated")
    # Saved, so that the join below has a plain shuffle on both sides, which Spark can split at a common seed.
    at = saved(left.filter("_id = least").groupBy("hash").agg(F.min(F.struct("_key", "start")).alias("at"))
               .select("hash", F.col("at._key").alias("ref_key"), F.col("at.start").alias("ref_start")), "line-first")
    return left.join(at, "hash").filter("not (_id = least and _key = ref_key and start = ref_start)").select("_id", "_key", "start", "end", F.col("least").alias("ref_id"), "ref_key", "ref_start")


def merged(text: np.ndarray, start: np.ndarray, end: np.ndarray, ref_id: np.ndarray, ref_key: np.ndarray, ref_start: np.ndarray) -> tuple:
    """Places of several texts: those of one text that overlap or meet and lie
    at one distance from their first place become one. Returns the rows that
    begin one, and where it ends."""
    if not len(text):
        return np.zeros(0, np.int64), end
    by = np.lexsort((end, start, start - ref_start, ref_key, ref_id, text))
    t, s, e = text[by], start[by].astype(np.int64), end[by].astype(np.int64)
    other = np.zeros(len(by), bool)
    for x in (t, ref_id[by], ref_key[by], s - ref_start[by]):
        other[1:] |= x[1:] != x[:-1]
    group = np.cumsum(other)
    reach = np.maximum.accumulate(e + (group << 32)) - (group << 32)       # the farthest end so far in the group
    begins = np.r_[True, other[1:] | (s[1:] > reach[:-1])]
    first = np.flatnonzero(begins)
    return by[first], reach[np.r_[first[1:], len(by)] - 1]


# What stands after a span in its first text: enough for units too short to be a seed's.
_AFTER = re.compile(rb"(?:\s*\S+){0,12}\s?")
_NEXT = re.compile(rb"\s*\S+")


def lengthened(raw: bytes, end: int, after: bytes, unit_ends) -> int:
    """The end of the last whole unit behind ``end`` that stands in ``after``
    too; ``unit_ends()`` gives the ends of the text's units."""
    word = _NEXT.match(after)
    if not word or not raw.startswith(word[0], end):
        return end
    n = len(os.path.commonprefix([raw[end:end + len(after)], after]))
    ends, out = unit_ends(), end
    for e in ends[np.searchsorted(ends, end, "right"):].tolist():
        if e - end > n or e - end < len(after) and not _SPACE[after[e - end]]:
            break
        out = e
    return out


def line_dedup(docs: DataFrame, how: Chunking = Chunking(), doc_id: str = "doc_id", text: str = "text",
               n_removed: str = "n_removed", removed_bytes: str = "removed_bytes") -> DataFrame:
    """``docs`` with the passages removed that stand earlier as well, and
    ``n_removed`` (passages: spans that overlap are one) and
    ``removed_bytes``, under names of choice. The first occurrence, by document id, stays, but for
    units that it shares with a passage found still earlier.

    Null and empty texts stay as they are, with nothing removed; a text of
    which all units go becomes empty. Equal rows count as one document, so
    each of them keeps its first occurrences. A null id sorts last. Other
    columns pass through, whatever their names: where one is named like a
    result, that result is left out. An empty table stays empty."""
    found = saved(found_seeds(docs, how, doc_id, text), "line-seeds")
    place = F.struct("start", "end", "ref_id", "ref_key", "ref_start")
    per_text = repeated_seeds(found).groupBy("_id", "_key").agg(F.collect_list(place).alias("places"))
    ddl = "_id long, _key long, start int, end int, ref_id long, ref_key long, ref_start int, size int"
    schema = arrow_schema(ddl)

    def to_spans(batches):
        for batch in batches:
            lists = batch.column("places")
            at = np.repeat(np.arange(batch.num_rows), np.array(lists.value_lengths()))
            s, e, ref_id, ref_key, r = (np.array(x) for x in lists.flatten().flatten())
            first, end = merged(at, s, e, ref_id, ref_key, r)
            ids, keys = (np.array(batch.column(c))[at[first]] for c in ("_id", "_key"))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, keys, s[first], end, ref_id[first], ref_key[first], r[first], end - s[first]), schema)],
                                             schema=schema)

    spans = saved(per_text.mapInArrow(to_spans, ddl), "line-spans")
    rows = _keyed(docs, doc_id, text)

    # The bytes of each first place, once for all who ask, or once for each of their salts: a passage
    # that very many texts share is then joined by as many tasks, and no place has more copies than texts that ask.
    salts = math.isqrt(spans.count()) // 16 + 1
    spans = spans.withColumn("salt", F.pmod(F.xxhash64("_id", "_key"), F.lit(salts)).cast("int"))
    asked = (spans.groupBy("ref_id", "ref_key", "ref_start", "size").agg(F.collect_set("salt").alias("salts"))
             .groupBy("ref_id", "ref_key").agg(F.collect_list(F.struct("ref_start", "size", "salts")).alias("asked")))
    slices_ddl = "ref_id long, ref_key long, ref_start int, size int, salt int, bytes binary, after binary"
    slices_schema = arrow_schema(slices_ddl)

    def to_slices(batches):
        for batch in batches:
            texts = batch.column("row").field(text).cast(pa.large_binary()).to_pylist()
            lists = batch.column("asked")
            start, size, salts_of = lists.flatten().flatten()
            times = np.array(salts_of.value_lengths())
            at = np.repeat(np.repeat(np.arange(batch.num_rows), np.array(lists.value_lengths())), times)
            start, size, salt = np.repeat(np.array(start), times), np.repeat(np.array(size), times), np.array(salts_of.flatten())
            cut, after = [], []
            for i, s, e in zip(at.tolist(), start.tolist(), (start + size).tolist()):
                cut.append(texts[i][s:e])
                after.append(_AFTER.match(texts[i], e)[0])
            ids, keys = (np.array(batch.column(c))[at] for c in ("ref_id", "ref_key"))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, keys, start, size, salt, cut, after), slices_schema)], schema=slices_schema)

    # Rows that are one document have one text: any of them will do, so equal slices count once.
    place = ["ref_id", "ref_key", "ref_start", "size", "salt"]
    slices = (rows.join(asked, (F.col("_id") == F.col("ref_id")) & (F.col("_key") == F.col("ref_key"))).select("ref_id", "ref_key", "asked", "row")
              .mapInArrow(to_slices, slices_ddl).dropDuplicates(place))
    cuts = spans.join(slices, place).groupBy("_id", "_key").agg(F.collect_list(F.struct("start", "bytes", "after")).alias("cuts"))
    results = [c for c in (n_removed, removed_bytes) if c not in docs.columns]
    out_schema = T.StructType([*[T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in docs.schema],
                               *[T.StructField(c, T.LongType()) for c in results]])

    def to_texts(batches):
        import xxhash

        for batch in batches:
            row, at = batch.column("row"), docs_columns.index(text)
            # Texts without a cut aren't touched.
            cut = np.flatnonzero(np.array(batch.column("cuts").is_valid()))
            n, size = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            texts = row.field(at)
            if len(cut):
                new = texts.cast(pa.large_binary()).to_pylist()
                lists = batch.column("cuts").take(pa.array(cut))
                start, parts, after = (x.to_pylist() for x in lists.flatten().flatten())
                ends = np.cumsum(np.array(lists.value_lengths())).tolist()
                for i, a, b in zip(cut.tolist(), [0, *ends], ends):
                    raw, gone, known = new[i], [], []

                    def unit_ends():
                        if not known:
                            known.append(all_units([raw], how)[2])
                        return known[0]

                    for s, part, more in zip(start[a:b], parts[a:b], after[a:b]):
                        if raw.startswith(part, s):
                            gone.append((s, lengthened(raw, s + len(part), more, unit_ends)))
                    if gone:
                        new[i], n[i], size[i] = without(raw, gone)
                texts = pa.array(new, pa.large_binary()).cast(texts.type)
            told = {n_removed: pa.array(n), removed_bytes: pa.array(size)}
            yield pa.RecordBatch.from_arrays([*[texts if i == at else row.field(i) for i in range(row.type.num_fields)], *[told[c] for c in results]],
                                             names=[*docs_columns, *results])

    docs_columns = docs.columns
    kept = rows.join(cuts, ["_id", "_key"], "left").select("row", "cuts").mapInArrow(to_texts, out_schema)
    return kept.withColumn(text, F.col(f"`{text}`").cast(docs.schema[text].dataType))


def without_repeats(docs: DataFrame, how: Chunking = Chunking(), doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` without passages that an earlier document has; a document of
    which no word is left goes. ``n_chars``, if there is such a column,
    follows the text where something was removed.

    Null, empty and blank texts stay as they are. Equal rows count as one
    document and stay or go together; a null id sorts last. Other columns
    stay, whatever their names; an empty table stays empty."""
    n, size = "removed", "removed_size"
    while {n, size} & set(docs.columns):
        n, size = n + "_", size + "_"
    out = line_dedup(docs, how, doc_id, text, n, size).filter((F.col(n) == 0) | F.col(f"`{text}`").rlike(r"\S"))
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        out = out.withColumn(n_chars, F.when(F.col(n) > 0, F.length(F.col(f"`{text}`")).cast(kind)).otherwise(F.col(f"`{n_chars}`")))
    return out.select(*[f"`{c}`" for c in docs.columns])


def without(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """``raw`` without the byte ranges ``spans``, which may overlap; how many
    ranges these are when joined, and their bytes. White space at a seam
    goes, but for one line end, or one blank within a line, and the next line's indent."""
    merged = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    out, broken = [], False                        # parts of the result, none of them blank
    for s, e in zip([0, *(e for _, e in merged)], [*(s for s, _ in merged), len(raw)]):
        part = raw[s:e]
        if s and out:
            body = out[-1].rstrip()
            broken, out[-1] = broken or b"\n" in out[-1][len(body):], body
        if part.strip():
            lead = part[:len(part) - len(part.lstrip())]
            if s:
                broken = broken or b"\n" in lead
                part = part[lead.rfind(b"\n") + 1:] if b"\n" in lead else part[len(lead):]
                if out:
                    out.append(b"\n" if broken else b" ")
            out.append(part)
            broken = False
        else:
            broken = broken or b"\n" in part
    return b"".join(out), len(merged), sum(e - s for s, e in merged)

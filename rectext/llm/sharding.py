"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked there. A
row's fractional rank is ``(rank - 1 + u) / rows of the source``, ``u`` in
[0, 1) a hash of the source (so that many small sources don't all stand at the
same place). In the order of fractional ranks every stretch holds of each
source its share, to within one row; that order is cut into shards whose
counts are at most one apart.

No source is ranked in one task: hash ranges of it are counted, the counts
added up, and each range ranks its own rows. The global order is cut the same
way, by ranges of the fractional rank.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rectext.llm.common import saved


def shuffle_key(doc_id: Column, text: Column, seed: int) -> Column:
    """The seeded hash that orders rows within a source; nulls count as empty."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))))


def _unit(hexadecimal: Column) -> Column:
    """First 32 bits of a hash in hexadecimal digits, as a long."""
    return F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("long")


def interleave(rows: DataFrame, shards: int, source: str = "source", key: str = "key", ranges: int | None = None) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from
    0 in each shard), and ``fraction``, the fractional rank. ``key`` is a
    column of hexadecimal hashes (see ``shuffle_key``); rows of one source
    with equal keys may change places.

    Null sources are a source of their own; an empty table gives no rows;
    with fewer rows than shards some shards stay empty. Input columns named
    like the three results are replaced, all others pass through whatever
    their names. Ties of the fractional rank go by source, then key. ``ranges``: into how
    many ranges hashes and fractional ranks are cut, by default the square
    root of the rows, so that neither a range nor the list of them is long."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    names = [c for c in rows.columns if c not in ("shard", "slot", "fraction")]
    # The row travels as one struct, so its names can't meet those used here.
    src = F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))
    x = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), src.alias("src"), F.col(key).alias("key"))
    n = x.count()
    ranges = ranges or math.isqrt(n) + 1
    x = x.withColumn("part", F.shiftright(_unit(F.col("key")) * ranges, 32).cast("int"))

    in_source = Window.partitionBy("src")
    counts = (x.groupBy("src", "part").agg(F.count(F.lit(1)).alias("n"))
              .withColumns({"before": F.coalesce(F.sum("n").over(in_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                            "of": F.sum("n").over(in_source)}).drop("n"))
    rank = F.row_number().over(Window.partitionBy("src", "part").orderBy("key"))
    ranked = (x.withColumn("rank", rank).join(counts, ["src", "part"])
              .withColumn("fraction", (F.col("before") + F.col("rank") - 1 + _unit(F.md5("src")) / F.lit(2.0 ** 32)) / F.col("of"))
              .select("row", "src", "key", "fraction", F.least(F.floor(F.col("fraction") * ranges), F.lit(ranges - 1)).cast("int").alias("part")))
    ranked = saved(ranked, "interleave-ranked")

    # One row a range.
    starts = (ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    place = F.row_number().over(Window.partitionBy("part").orderBy("fraction", "src", "key"))
    placed = (ranked.withColumn("place", place).join(starts, "part").withColumn("at", F.col("before") + F.col("place") - 1)
              .withColumn("shard", F.expr(f"(at * {shards}) div {max(n, 1)}")))
    return placed.select(*[F.col(f"row.`{c}`").alias(c) for c in names], F.col("shard").cast("int").alias("shard"),
                         F.expr(f"at - (shard * {n} + {shards - 1}) div {shards}").alias("slot"), "fraction")


def shard_documents(docs: DataFrame, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Whole documents with ``shard``, ``slot`` and ``fraction``. Rows equal
    in id and text share their place in the shuffle; null ids and texts count
    as empty there."""
    taken = "key"
    while taken in docs.columns:
        taken += "_"
    return interleave(docs.withColumn(taken, shuffle_key(F.col(doc_id), F.col(text), seed)), shards, source, taken).drop(taken)


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder a shard, rows in the order of their slots within each file;
    a large shard is several files of consecutive slots."""
    n = placed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed.repartitionByRange(int(n), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)


def place_documents(docs: DataFrame, shards: int = 24, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The digest of a sharding: ``doc_id, size`` (UTF-8 bytes and 8),
    ``text_crc32, law, shard, slot, grown_shard`` and ``source, fraction``.
    The law is ``rows``, so ``grown_shard`` is null. A null text has size 8
    and the crc of no bytes. Texts are read once and not carried on."""
    t = F.col(text).cast("string")
    rows = saved(docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 8).cast("long").alias("size"),
                             F.crc32(F.coalesce(t, F.lit(""))).alias("text_crc32"), F.col(source).cast("string").alias("source"),
                             shuffle_key(F.col(doc_id).cast("long"), t, seed).alias("key")), "shard-rows")
    return interleave(rows, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                           F.lit(None).cast("int").alias("grown_shard"), "source", "fraction")

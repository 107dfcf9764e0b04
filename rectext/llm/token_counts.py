"""Token counts by an exact length histogram.

Documents are aggregated by encoded length; that histogram is all that the
later questions need. Suffix sums over it give, for every context limit, the
tokens kept if documents are truncated there, the documents that are cut, and
the quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rectext.llm.common import map_rows
from rectext.llm.words_bpe import encoder


def encoded_lengths(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` of every whole text (null or empty: 0 tokens)."""
    def start():
        coder = encoder(tokenizer)
        return lambda ids, texts: {"doc_id": ids, "n_tokens": [len(b) // 4 for b in coder.encode_all([t.decode() if t else "" for t in texts])]}

    return map_rows(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")), "doc_id long, n_tokens long", start)


def length_histogram(lengths: DataFrame, by: str = "n_tokens") -> DataFrame:
    """``n_tokens, n_docs``: exact; partial sums in each task first."""
    return lengths.groupBy(F.col(by).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def limits_table(histogram: DataFrame, band: int = 4096) -> DataFrame:
    """For each context limit that occurs as a length: ``context_limit,
    n_docs`` (of exactly that length), ``docs_up_to``, ``docs_over``,
    ``tokens_up_to``, ``tokens_truncated`` (all documents cut at the limit),
    ``docs_total, tokens_total`` and ``quantile`` (share of documents up to
    the limit). Answers for limits between two lengths follow from the lower
    one: each document over it adds the difference.

    The running sums are taken in two steps, inside bands of ``band``
    lengths and over the bands, so no task sorts the whole histogram. An
    empty table gives no rows."""
    h = histogram.withColumn("band", F.floor(F.col("n_tokens") / band)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    inside = Window.partitionBy("band").orderBy("n_tokens")
    bands = h.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # One row a band, at most 2^31 / band of them as a text is no longer than that: one task adds them up.
    earlier = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    before = bands.select("band", F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("docs_before"), F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("tokens_before"))
    total = bands.agg(F.sum("d").alias("docs_total"), F.sum("t").alias("tokens_total"))
    x = (h.withColumns({"docs_in": F.sum("n_docs").over(inside), "tokens_in": F.sum("tokens").over(inside)})
         .join(before, "band").join(F.broadcast(total)))
    up_to, over = F.col("docs_before") + F.col("docs_in"), F.col("docs_total") - F.col("docs_before") - F.col("docs_in")
    short = F.col("tokens_before") + F.col("tokens_in")
    return x.select(F.col("n_tokens").alias("context_limit"), "n_docs", up_to.alias("docs_up_to"), over.alias("docs_over"),
                    short.alias("tokens_up_to"), (short + F.col("n_tokens") * over).alias("tokens_truncated"),
                    "docs_total", "tokens_total", (up_to / F.col("docs_total")).alias("quantile"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """``tokens``: all documents' tokens if each is cut at ``limit``."""
    return histogram.agg(F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("tokens"))


def length_quantile(table: DataFrame, q: float) -> DataFrame:
    """``n_tokens``: the smallest length that at least the share ``q`` of the documents doesn't exceed."""
    return table.filter(F.col("quantile") >= q).agg(F.min("context_limit").alias("n_tokens"))

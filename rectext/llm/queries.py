"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from rectext.llm import (hard_negatives, lang_id, lexical_search, licenses, line_dedup, near_dedup, packing, quality, quotations,
                         sentence_pieces, sharding, token_counts, vp_search)
from rectext.llm.common import saved, table

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_quotation_linking(spark, sf_dir):
    """``conversations`` in mail form (turns that quote the turns before
    them): own texts and reply trees, one row a message."""
    mails = quotations.as_replies(table(spark, sf_dir, "conversations"))
    return quotations.link_quotations(mails, text="mail")


def op2_license_scan(spark, sf_dir):
    """``documents``: base places and the rules' labels, one row a document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    """``documents``: base rules and distribution divergence from the languages' references."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality_rules(docs, quality.language_references(docs))


def op4_vantage_point_search(spark, sf_dir):
    """``embeddings``: 20 nearest of each row whose id is divisible by 20."""
    return vp_search.nearest(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark, sf_dir):
    """``documents``: predicted language and calibrated score, one row a document."""
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    """``documents`` without repeated chunks of lines."""
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_removed", "removed_bytes", F.crc32("text").alias("text_crc32"), "text")


def op8_sentence_pieces(spark, sf_dir):
    """``documents``: pieces of whole texts, parity with the sentencepiece library and round trip."""
    return sentence_pieces.encode_documents(table(spark, sf_dir, "documents"), PIECE_BPE, with_ids=False)


def op7_near_dedup(spark, sf_dir):
    """``documents``: near-duplicate classes at five words and similarity 0.75."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark, sf_dir):
    """``documents``: power-of-two pieces, each a sequence of its bucket."""
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, with_ids=False)


def op10_token_counts(spark, sf_dir):
    """``documents``: for each encoded length, counts, quantile and truncated total."""
    lengths = token_counts.encoded_lengths(table(spark, sf_dir, "documents"), WORD_BPE)
    return token_counts.limits_table(saved(token_counts.length_histogram(lengths), "length-histogram"))


def op11_hard_negatives(spark, sf_dir):
    """``embeddings``: negatives for the nearest of the own label of each row whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", label.alias("label"), hard_negatives.whole_vector("embedding").alias("vector")), F.col("vec_id") % 50 == 0)


def op12_sharding(spark, sf_dir):
    """``documents`` in 24 shards, each with the mixture of sources of the whole."""
    return sharding.place_documents(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark, sf_dir):
    """``documents`` ranked for each ``benchmark`` item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_quotation_linking, op2_license_scan, op3_quality_rules, op4_vantage_point_search, op5_language_id, op6_line_dedup,
    op7_near_dedup, op8_sentence_pieces, op9_packing, op10_token_counts, op11_hard_negatives,
    op12_sharding, op13_lexical_search)}

ORACLE = {
    # The mail form quotes the turn before at level one, so each turn answers it.
    "op1_quotation_linking": """
        SELECT conv_id, turn, coalesce(text, '') AS own_text, least(turn, 2) AS max_level,
               CASE WHEN turn >= 1 THEN 1 ELSE 0 END + CASE WHEN turn >= 2 THEN 1 ELSE 0 END AS n_quoted,
               CASE WHEN turn >= 1 THEN 1 ELSE 0 END + CASE WHEN turn >= 2 THEN 1 ELSE 0 END AS n_linked,
               CASE WHEN turn >= 1 THEN turn - 1 END AS parent_order, 0::BIGINT AS root_order, turn AS depth
        FROM conversations""",
    # Factor one makes the search exact.
    "op4_vantage_point_search": """
        WITH good AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20""",
    "op11_hard_negatives": """
        WITH good AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id AS id, b.label = a.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM good a JOIN good b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS p FROM scored WHERE same QUALIFY p <= 5),
        negatives AS (
            SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.a, p.p ORDER BY n.score DESC, n.id) AS rank
            FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
            QUALIFY rank <= 3)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives""",
    "op12_sharding": """
        WITH crc_table AS (
            SELECT list(c ORDER BY i) AS tab FROM (
                SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM (SELECT unnest(range(256)) AS i))),
        bytes AS (
            SELECT *, list_transform(string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g'), ' ')[:-2],
                                     lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
        base AS (
            SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size, source,
                   xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
                   CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS src,
                   md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS key
            FROM bytes, crc_table),
        ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY src ORDER BY key) - 1 + ('0x' || md5(src)[1:8])::BIGINT / 4294967296.0::DOUBLE)
                      / count(*) OVER (PARTITION BY src) AS fraction FROM base),
        placed AS (
            SELECT *, row_number() OVER (ORDER BY fraction, src, key) - 1 AS pos, count(*) OVER () AS n FROM ranked),
        cut AS (SELECT *, (pos * 24) // n AS shard FROM placed)
        SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
               (pos - (shard * n + 23) // 24)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source, fraction
        FROM cut""",
    "op13_lexical_search": """
        WITH docs AS (
            SELECT * FROM (
                SELECT doc_id, row_number() OVER () AS r,
                       regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
                FROM documents WHERE text IS NOT NULL) WHERE len(terms) > 0),
        total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs),
        items AS (
            SELECT item_id, term, count(*) AS qtf FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
            GROUP BY item_id, term),
        counts AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
                   FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY r, term),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total),
        scores AS (
            SELECT item_id, r, any_value(doc_id) AS doc_id,
                   sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM items JOIN counts USING (term) JOIN weights USING (term), total GROUP BY item_id, r)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 20""",
}

"""A corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and reread as the next one's ``docs``. All but the last
return the columns of ``documents``. What a stage does with nulls, repeated
rows and the like is stated at the function that it calls.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rectext.llm import lang_id, line_dedup, near_dedup, packing, quality  # noqa: E402
from rectext.llm.common import saved, table  # noqa: E402
from rectext.llm.queries import WORD_BPE  # noqa: E402

#: Least calibrated probability of a language.
MIN_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language, which becomes their ``lang``."""
    return lang_id.recognised(docs, MIN_SCORE)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_documents(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    return line_dedup.without_repeats(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return near_dedup.representatives(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of what is left."""
    return packing.pack(docs, WORD_BPE, with_ids=False)


STAGES = [
    ("language_id", language),
    ("quality_rules", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_near_copies),
    ("packing", packed),
]

#: No SQL form: trained model, tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

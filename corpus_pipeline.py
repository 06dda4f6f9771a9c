"""Corpus pipeline over ``documents``.

Each stage works on all its predecessor kept; every stage but the last returns the
columns of ``documents``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from itemtrack.llm.common import fold, materialize, read_table

# A text that is this far from every language (cosine) is not taken as text of any.
MIN_LANGUAGE_SCORE = 0.01
# The cut for texts of 100 distinct grams or more, less in proportion for shorter ones: unlearned texts
# have 1/32 times a normal number for each language; a few clean words may have as little.
MIN_LONG_SCORE = 0.125


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose text has a language (operator 6).  Null and empty texts and
    texts without letters go, and texts far from all languages.  The profiles learn from the labelled documents outside
    the held-out fold."""
    from itemtrack.llm.langid import LanguageProfiles
    profiles = LanguageProfiles().fit(docs.filter(fold("doc_id", 4) != 2))
    return profiles.keep_rows(docs, MIN_LANGUAGE_SCORE, MIN_LONG_SCORE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that pass the base rules and the n-gram ratio (operator 9)."""
    from itemtrack.llm.quality import QualityRatio
    return QualityRatio().fit(docs, read_table(spark, sf_dir, "labels")).keep_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate class, that of the smallest id (operator 7)."""
    from itemtrack.llm.dartminhash import keep_one
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the rows that are left into sequences of at most 1024 tokens (operator 5): one
    row per piece with its sequence and its offset there."""
    import public_tokenizers
    from itemtrack.llm.packing import pack
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", packing)]

ORACLE_SQL = None  # models and hashes: tested against brute-force versions instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each written to the shared folder and read again."""
    def step(docs: DataFrame, stage) -> DataFrame:
        return stage[1](spark, materialize(docs, f"pipeline-{stage[0]}"), sf_dir)

    first = STAGES[0][1](spark, read_table(spark, sf_dir, "documents"), sf_dir)
    return reduce(step, STAGES[1:], first)

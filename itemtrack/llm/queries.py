"""The registered queries of this subpackage, and their DuckDB oracles where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from itemtrack.llm import oracles
from itemtrack.llm.common import fold, read_table

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
N_SHARDS = 16


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from itemtrack.llm.bpe import BpeTokenizer
    bpe = BpeTokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), "doc_id")
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
    decoded = bpe.decode(encoded, "doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         digest.alias("ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from itemtrack.llm.token_counts import UnigramVocabulary, count_tokens
    vocabulary = UnigramVocabulary.from_model(public_tokenizers.path("piece_bpe_32k.model"))
    return count_tokens(read_table(spark, sf_dir, "documents"), vocabulary, "doc_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from itemtrack.llm.packing import pack
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 100, as a query against all documents."""
    from itemtrack.llm.search import build_index, top_k
    docs = read_table(spark, sf_dir, "documents")
    return top_k(build_index(docs), docs.filter(F.col("doc_id") % 100 == 0), k=10)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.urls import UrlFilter, labelled_pages
    pages, labels = read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels")
    return UrlFilter().fit(labelled_pages(pages, labels), count_col="pages").judge(pages, URL_RULES)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.langid import LanguageProfiles
    docs = read_table(spark, sf_dir, "documents")
    profiles = LanguageProfiles().fit(docs.filter(fold("doc_id", 4) != 2))
    return profiles.predict(docs, "doc_id", (fold("doc_id", 4) == 2).alias("held_out"))


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.dartminhash import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.sharding import byte_shards
    shards = byte_shards(read_table(spark, sf_dir, "documents"), N_SHARDS)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.quality import QualityRatio
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return QualityRatio().fit(docs, labels).measure(docs, "doc_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.lm import score
    scored = score(read_table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.positional import contamination
    judged = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.conversations import Repair, damage, talk_digests
    given = read_table(spark, sf_dir, "conversations")
    repair = Repair(damage(given))
    # One row per conversation from each part; conversations without rows after the damage have only the first.
    parts = (given.select("conv_id").distinct().unionByName(repair.summary, allowMissingColumns=True)
             .unionByName(talk_digests(repair.repaired()), allowMissingColumns=True))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from itemtrack.llm.spelling import spelling_variants
    return spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_byte_bpe, op2_search, op3_url_filter, op4_token_counts, op5_packing, op6_language_id, op7_dart_minhash,
    op8_sharding, op9_quality_rules, op10_lm_scoring, op11_decontamination, op12_conversation_repair,
    op13_spelling_variants)}

ORACLE = {"op8_sharding": oracles.SHARDING, "op11_decontamination": oracles.DECONTAMINATION}

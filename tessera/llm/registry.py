"""Registered queries of this package: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The queries' parameters. The key is a test key; jobs pass their own.
PII_KEY = "registered-query-key"
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


# Rules of the URL query, and names of hosts whose pages make up its list.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
BLOCKED_NAMES = ["spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the rules and a list of URLs: those of the
    pages on hosts with a blocked name."""
    from tessera.llm import url_filter as u
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = u.with_parts(pages).filter(F.col("host").rlike(r"(^|\.)(" + "|".join(BLOCKED_NAMES) + r")(\.|$)")).select("url")
    return u.filter_urls(pages, u.rule_table(spark, URL_RULES), listed).select("page_id", "host", "path", "rule", "verdict")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.source_mix import mix
    return mix(table(spark, sf_dir, "documents"))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced (test: brute force)."""
    from tessera.llm.pii import pseudonymise
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.ann import nearest_neighbours
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op7_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import judge
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.sharding import shard
    return shard(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.bpe import encode
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), ids=False, digests=True)


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.lm import lm_scores
    return lm_scores(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.spelling import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.lsh_forest import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.conversation_trie import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_url_filter, op2_source_mix, op3_pii_pseudonyms, op4_jaccard_join, op5_toxicity, op6_nearest_neighbours, op7_quality_votes, op8_sharding, op9_bpe, op10_lm_scores,
        op11_spelling_variants, op12_lsh_forest, op13_conversation_trie)}

"""The queries of this package by name, and the SQL of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm import (
    byte_bpe, cap_filters, language, licences, mixing, packing, preferences, prefix_trie, scaled_sketch, secrets, setsketch, site_quality, token_spans,
)
from tallybrook.llm.common import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.format_preferences(table(spark, sf_dir, "conversations"))


def op4_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.similar_vectors(table(spark, sf_dir, "embeddings"))


def op5_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op6_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.fingerprints(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode_documents(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_spans.align_documents(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_secret_scan, op3_preference_pairs, op4_cap_filters, op5_pack_windows, op6_licence_rules,
        op7_mix_sources, op8_setsketch_dedup, op9_site_quality, op10_scaled_fingerprints,
        op11_byte_bpe, op12_token_spans, op13_prefix_trie,
    )
}
LLM_SQL: dict[str, str] = {"op6_licence_rules": licences.SQL}

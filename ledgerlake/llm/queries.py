"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, extract, licenses, lm, minhash, repeats, sentencepieces, sharding, spelling, topk, toxicity, trie, urls
from .common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.as_files(table(spark, sf_dir, "documents")))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_documents(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.cut_repeats(table(spark, sf_dir, "documents")))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash_near_dedup, op2_license_scan, op3_sentencepiece, op4_exact_top_k, op5_sharding,
                               op6_toxicity, op7_suffix_array_dedup, op8_html_extraction, op9_lm_scoring,
                               op10_benchmark_decontamination, op11_url_filter, op12_spelling_variants,
                               op13_conversation_trie)}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": minhash.SQL,
    "op2_license_scan": licenses.SQL,
    "op4_exact_top_k": topk.SQL,
    "op5_sharding": sharding.SQL,
    "op7_suffix_array_dedup": repeats.SQL,
    "op10_benchmark_decontamination": decontaminate.SQL,
    "op11_url_filter": urls.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_conversation_trie": trie.SQL,
}

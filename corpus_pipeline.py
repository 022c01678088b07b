"""The corpus pipeline: each stage is one operator on what the stage before it kept.

``run`` writes every stage as Parquet in the shared folder of the session and hands
the reread table to the next one, so a lost executor costs no earlier stage.  All but
the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontaminate, minhash, repeats, sentencepieces, toxicity
from ledgerlake.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5 words, similarity 0.8."""
    return minhash.keep_one(docs, words=5)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document with a smaller id holds are cut out."""
    return repeats.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each text, checked by decoding them again."""
    return sentencepieces.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("repeated_text", repeated_text),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Toxicity, MinHash and tokens can't be expressed in SQL; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

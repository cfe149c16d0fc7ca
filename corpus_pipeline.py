"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes what the one before it kept; `run` applies them to `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm.common import stored
from rivulet.llm.exact import keep_one_of_equals
from rivulet.llm.language import keep_known_languages
from rivulet.llm.mixing import mixed_documents
from rivulet.llm.near import keep_one_of_near
from rivulet.llm.packing import packed_documents
from rivulet.llm.queries import table, tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles know."""
    return keep_known_languages(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return keep_one_of_equals(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of near-duplicates."""
    return keep_one_of_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the training sequences."""
    return packed_documents(docs, tokenizer())


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
# Language, near-duplicates and packing are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

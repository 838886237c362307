"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return rows of ``docs`` as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import attention, edit_match, near_duplicates, packing, run_merge
from logloom.llm.queries import tokenizer_definition
from logloom.session import delete, settled_here, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled documents of the whole corpus."""
    corpus, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return attention.accepted(docs, attention.quality_model(corpus, labels))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return run_merge.keep_first(docs)


def one_of_each_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, direct or by way of others, the one with the smallest id."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return edit_match.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of at most 2048 tokens."""
    return packing.packed(docs, tokenizer_definition())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("exact dedup", first_copies),
    ("near dedup", one_of_each_kind),
    ("decontamination", without_benchmark),
    ("packing", sequences),
]

#: SQL cannot express the classifier or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is written to the shared folder and read by the next.

    What a stage settled on its way is deleted when its result is written, and that when the next stage is done.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        with settled_here(spark):
            docs, path = written(stage(spark, docs, sf_dir))
        if before is not None:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus job: quality, exact copies, near copies, mixture, packing. Each stage is one operator of ``cohortlens.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``. Nulls, empty texts, repeated rows and empty tables are handled as
the operators state; extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.llm import compression, exact, jaccard, mixing, packing
from cohortlens.llm.store import noting, release, stored

QUALITY_FLOOR = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; it learns from ``labels`` outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return compression.kept(docs, labels, threshold=QUALITY_FLOOR)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text, the one with the largest id stays."""
    return exact.kept(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the least id stays."""
    return jaccard.kept(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes of a document; the last one of a source may be cut."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, in the proportions of the mix."""
    out = packing.pack(docs)
    return out.withColumnRenamed("id", "doc_id")


_left: list[str] = []


def _stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Tables that the stage before wrote on its way go first: its result is written by then, as ``docs``."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _left)
        with noting(_left):
            return fn(spark, docs, sf_dir)

    run_stage.__doc__ = fn.__doc__
    return run_stage


STAGES = [
    (name, _stage(fn))
    for name, fn in (("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mixture", mixture), ("packing", packed))
]
#: The classifier and the tokenizer cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs

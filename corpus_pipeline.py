"""Corpus pipeline: documents through toxicity, near duplicates, secrets, mixing and packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next stage's ``docs``. All stages but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heliolake.llm.common import stored, table
from heliolake.llm.mixing import mixed_documents
from heliolake.llm.ngram_join import one_of_each_group
from heliolake.llm.packing import pack
from heliolake.llm.secrets import live_secrets_masked
from heliolake.llm.toxicity import learn, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from ``labels``, rejects go."""
    return without_toxic(docs, learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words a shingle, similarity 0.8."""
    return one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked; every document stays."""
    return live_secrets_masked(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to their target weights; a repeated document is a repeated row."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of at most 1024 tokens."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: Toxicity is learned from labels, so no SQL gives these rows. Each operator is tested against a plain version, the stages by what they keep and change.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

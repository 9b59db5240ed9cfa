"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantlens.llm import decontaminate, jaccard, packing, pii, quality
from grantlens.llm.common import staged, table
from grantlens.llm.queries import vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, folder, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 4096 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [("quality", good_quality), ("near_duplicates", without_near_duplicates), ("decontamination", decontaminated),
          ("personal_data", without_personal_data), ("packing", packed)]

# Neither a trained classifier nor a packing is SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, folder))
    return docs

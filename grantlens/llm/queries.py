"""The registered queries of this package, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, checks, decontaminate, extract, jaccard, merkle, minmax, neighbours, packing, pii, ppm, quality, tokenfiles, urls
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = dict(checks.SQL)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows found in each document."""
    return decontaminate.measure(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, folder, "documents"), vocabulary())


@query
def op3_ppm(spark: SparkSession, folder: str) -> DataFrame:
    """The PPM score of each document, and that of a unigram model."""
    return ppm.scores(table(spark, folder, "documents"))


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for each document."""
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The rule that decides on each page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, folder, "pages"), rules)


@query
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near duplicates of each document, and how many documents it links with."""
    return jaccard.linked(table(spark, folder, "documents"))


@query
def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest neighbours of every fiftieth vector."""
    return neighbours.search(table(spark, folder, "embeddings"))


@query
def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of each page."""
    return extract.extract(table(spark, folder, "pages"))


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files and read back."""
    return tokenfiles.encode_and_read(table(spark, folder, "documents"), vocabulary())


@query
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in each document."""
    return pii.digest(table(spark, folder, "documents"))


@query
def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's cluster after five rounds over 40 centroids."""
    return centroids.assigned(table(spark, folder, "embeddings"))


@query
def op12_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near duplicates of each document at a similarity of 0.85, and whether the document stays."""
    return minmax.near_duplicates(table(spark, folder, "documents"))


@query
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, proof and verification in a Merkle tree of all documents."""
    return merkle.manifest(table(spark, folder, "documents"))

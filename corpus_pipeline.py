"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, SentencePiece ids.

Each stage is written as Parquet in the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import mixing, pieces, pii, quality, simhash
from stationflow.llm.common import fixed, ready, table, table_or_none
from stationflow.llm.queries import PIECE_MODEL

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return quality.keep_good(docs, table_or_none(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return pii.redact(docs, pii.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.mix(docs)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return pieces.digests(docs, pieces.Model.load(PIECE_MODEL), keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("sentencepiece_ids", sentencepiece_ids),
]

# The trees, the fingerprints' hash and the merge order cannot be put in SQL; tests/llm compares the
# stages with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; one row per document of the mix, with its ids and their digests."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = fixed(stage(spark, docs, sf_dir), name)
    return docs

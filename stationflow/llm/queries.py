"""Registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm import ann, importance, langid, licenses, mixing, packing, periodic, pieces, pii, quality, simhash, token_files, warc
from stationflow.llm.common import table, table_or_none

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return token_files.read(spark, files)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table_or_none(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.Model.load(PIECE_MODEL))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(spark, warc.write_pages(table(spark, sf_dir, "pages")))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces_ = packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return pieces_.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_planted_periods(table(spark, sf_dir, "documents"))
    return periodic.summary(periodic.periodic_runs(docs))


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_pii": op5_pii,
    "op6_mixing": op6_mixing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_packing": op11_packing,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op12_importance_resampling": importance.oracle(),
    "op13_periodic_runs": periodic.oracle(),
    "op4_license_scan": licenses.oracle(),
    "op10_warc": """
        WITH stored AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), firsts AS (
            SELECT payload_digest, min(page_id) AS first_id FROM stored WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM stored LEFT JOIN firsts USING (payload_digest)
    """,
}

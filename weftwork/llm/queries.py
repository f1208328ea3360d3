"""The registered queries of the operators: each applies one, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm import (
    decontaminate, divergence, embed_dedup, exact_dedup, html_text, langid, license, line_dedup, merkle, packing, quality, simhash,
    toxicity,
)

ACCEPT = 0.7


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def _predicted(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    return license.scan(documents, license.fit(documents))


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    model = toxicity.fit(documents, _read(spark, folder, "labels"))
    return _predicted(toxicity.score(documents, model))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_read(spark, folder, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_read(spark, folder, "pages"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    return _predicted(quality.score(documents, quality.fit(documents, _read(spark, folder, "labels"))))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.summary(_read(spark, folder, "documents"), short=True)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    return langid.predict(documents, langid.fit(documents))


def op10_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.near_duplicates(_read(spark, folder, "embeddings"))


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(_read(spark, folder, "documents")).drop("n_chars")


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_read(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audited(_read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_benchmark_decontamination, op3_toxicity, op4_packing, op5_simhash_near_dedup, op6_html_extraction,
        op7_quality_classifier, op8_line_dedup, op9_language_id, op10_embedding_near_dedup,
        op11_exact_dedup, op12_source_divergence, op13_merkle_manifest,
    )
}

SQL: dict[str, str] = {
    "op11_exact_dedup": exact_dedup.SQL, "op12_source_divergence": divergence.SQL, "op13_merkle_manifest": merkle.SQL,
}

"""One query for each operator of this subpackage, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import best_fit_packing, byte_bpe, language_id, license_scan, line_dedup, lm_scoring, quality_rules, simhash, suffix_dedup, vector_graph
from gleaner.llm.common import read_documents


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(read_documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_packing.pack(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read_documents(spark, sf_dir))
    return out.select("doc_id", simhash.to_hex("fp").alias("fingerprint"), F.col("component").alias("component_id"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_documents(spark, sf_dir)).drop("spans")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.add_quality(read_documents(spark, sf_dir).select("doc_id", "text")).select(*quality_rules.COLUMNS)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode_decode(read_documents(spark, sf_dir), public_tokenizers.path(byte_bpe.PATTERN_FILE), public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_best_fit_packing, op3_simhash, op4_line_dedup, op5_vector_graph, op6_language_id, op7_license_scan, op8_quality_rules, op9_lm_scoring, op10_byte_bpe)}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": line_dedup.oracle(), "op8_quality_rules": quality_rules.oracle()}

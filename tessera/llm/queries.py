"""The registered queries of this subpackage: (spark, sf_dir) to the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import exact_dedup, language_id, line_dedup, merkle, mixing, ngram_join, packing, quality, secret_scan, sharding, spelling, token_counts, token_files
from .common import documents, work_path


def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Per document: lines, lines removed as boilerplate, and the digest of what is left."""
    out = line_dedup.remove_boilerplate(documents(spark, d))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op2_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    """Three loads into one ledger, then the report over all rows: half of the blobs under older
    rules, the other half, and all of them under today's version of one rule."""
    ledger = secret_scan.Ledger(spark, work_path(spark, "ledger"))
    return secret_scan.scan_in_loads(documents(spark, d), ledger)


def op3_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.balanced_shards(documents(spark, d))


def op4_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.judged(documents(spark, d)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rejected_by",
        *quality.MEASURES,
    )


def op5_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_id.identify(documents(spark, d))


def op6_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.similar_components(documents(spark, d))


def op7_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, d))


def op8_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_pieces(documents(spark, d))


def op9_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, d))


def op10_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    out = mixing.taken(mixing.mix(documents(spark, d)))
    return out.withColumn("target", F.round("target", 6))


def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.variants(documents(spark, d))


def op12_token_files(spark: SparkSession, d: str) -> DataFrame:
    """The files are written and read back."""
    path = work_path(spark, "token-files")
    token_files.write_files(documents(spark, d), path)
    return token_files.read_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.manifest(documents(spark, d)).drop("copies")


REGISTRY = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_secret_scan,
        op3_sharding,
        op4_quality_rules,
        op5_language_id,
        op6_ngram_join,
        op7_exact_dedup,
        op8_packing,
        op9_token_counts,
        op10_source_mixing,
        op11_spelling_variants,
        op12_token_files,
        op13_merkle_manifest,
    )
}

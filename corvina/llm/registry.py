"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, line_dedup, ngram_join, packing, quality_classifier, secrets, substring_dedup, warc
from .common import table
from .pii import detect_pii
from .quality_rules import quality_rules


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score_documents(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_pii(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.summary(decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")).drop("spans")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_classifier, op2_pii, op3_line_dedup, op4_warc, op5_secrets, op6_ngram_jaccard_join, op7_best_fit_packing, op8_decontamination, op9_quality_rules, op10_suffix_dedup, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": line_dedup.ORACLE_SQL,
        "op4_warc": warc.ORACLE_SQL,
        "op6_ngram_jaccard_join": ngram_join.ORACLE_SQL,
        "op8_decontamination": decontamination.ORACLE_SQL,
        "op10_suffix_dedup": substring_dedup.ORACLE_SQL,
    }

"""A training-corpus pipeline: each stage takes the documents that the one before kept.

STAGES: (name, function of (spark, docs, sf_dir)). All but the last return the columns of documents;
n_chars follows the text. Other columns are left behind by the first stage. Nulls and empty texts are
treated as the stages' operators define: they are kept unless the classifier rejects them. Rows with a
null doc_id are never repeats of others, but go if they are rejected or hold a benchmark passage. Of rows that
repeat a doc_id and its text one stays (of least lang, source and n_chars); rows of another text under
the same doc_id share the fate of that id among near duplicates, and have their own
before and after. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.llm import decontamination, line_dedup, ngram_join, packing, quality_classifier
from corvina.llm.common import table, written
from corvina.llm.registry import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs.select(COLUMNS), model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of smaller id holds go from the others."""
    kept = line_dedup.dedup_lines(docs.select(COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect, the one of smallest id stays."""
    docs = docs.select(COLUMNS)
    found = ngram_join.jaccard_components(docs).where(F.col("component_id") < F.col("doc_id"))
    # Written, so that Spark knows the size of what it may broadcast.
    kept = docs.join(written(found.select("doc_id").distinct()), "doc_id", "left_anti")
    repeated = written(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return kept.select(COLUMNS)
    rest = F.struct(*(c for c in COLUMNS if c not in ("doc_id", "text")))
    once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(rest).alias("rest")).select("doc_id", "text", "rest.*")
    return kept.join(repeated, "doc_id", "left_anti").select(COLUMNS).unionByName(once.select(COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go.

    The verdict depends on the text alone, so that rows are known by their text's hash: ids may be
    null or repeat. A clean text shares a hash with a contaminated one with a probability of 2^-64.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    found = decontamination.contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).where(F.size("runs") > 0)
    hit = written(found.select(F.col("doc_id").alias("__key")).distinct())
    return docs.select(COLUMNS).join(hit, key == F.col("__key"), "left_anti").select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs


#: The classifier's votes and the tokenizer have no SQL form: tests hold every stage against a plain version.
ORACLE_SQL = None

"""Line dedup: a line found in several documents stays only in the document of smallest id.

Line keys are hashed (two 64-bit hashes), range-partitioned by hash and sorted within each range by
document and position; the first document of a key is streamed along the sorted rows. So that one
line that most documents hold does not end in one task, the first pass works on (hash, salt): all
but the first document of a salt lose the line for sure. In a second pass the at most SALTS first
documents of each hash meet. What is returned is a compressed bitmap for each document: the runs of
dropped lines, not text. Only DataFrame functions are used.

A null text is one empty line, like an empty one. Rows with a null doc_id keep all their lines and
drop none of others. Rows that repeat a doc_id with the same text get the same bitmap; with
another text they are separate documents of equal id, and keep lines they share. Very long texts
are exploded into rows like any others. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, parallelism

MIN_CHARS, SALTS = 10, 64
SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(x: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.when(F.length(x) == F.octet_length(x), F.lower(x)).otherwise(F.translate(x, string.ascii_uppercase, string.ascii_lowercase))


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash and dropped (runs of dropped lines: start, n), for documents that lose lines."""
    base = id_text(docs).where(F.col("doc_id").isNotNull())
    lines = base.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("doc_id", "text_hash", "pos", F.trim("line", F.lit(SPACE)).alias("line")).where(F.length("line") >= min_chars)
    lines = lines.withColumn("line", ascii_lower(F.col("line")))
    rows = lines.select("doc_id", "text_hash", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))

    order = Window.orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = rows.repartitionByRange(parallelism(docs.sparkSession), "h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", "doc_id", "pos")
    first = F.first("doc_id").over(order.partitionBy("h1", "h2", "salt"))
    # 0: in the first document of its salt; else the line goes, and its row is spread by its salt.
    passed = ranged.withColumn("lost", F.when(F.col("doc_id") > first, F.col("salt") + 1).otherwise(0)).drop("salt")
    first = F.first("doc_id").over(order.partitionBy("h1", "h2", "lost"))
    dropped = passed.withColumn("first", first).where((F.col("lost") > 0) | (F.col("doc_id") > F.col("first")))

    dropped = dropped.select("doc_id", "text_hash", "pos", (F.col("pos") - F.dense_rank().over(Window.partitionBy("doc_id", "text_hash").orderBy("pos"))).alias("run"))
    runs = dropped.groupBy("doc_id", "text_hash", "run").agg(F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + 1).alias("n"))
    return runs.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("dropped"))


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines of text outside the runs, joined again."""
    lines = F.split(text, "\n", -1)
    gone = F.flatten(F.transform(dropped, lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.when(dropped.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """docs with their own columns, text without the dropped lines; n_lines (before) and n_dropped come in columns of those names, last."""
    keyed = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("__hash", F.xxhash64("__text"))
    maps = bitmaps.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__map_hash"), F.col("dropped").alias("__dropped"))
    joined = keyed.join(maps, (F.col("doc_id").cast("long") == F.col("__id")) & (F.col("__hash") == F.col("__map_hash")), "left")
    n_dropped = F.aggregate("__dropped", F.lit(0).cast("long"), lambda n, x: n + x["n"])
    own = [F.col(c) for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return joined.select(*own, kept_text(F.col("__text"), F.col("__dropped")).alias("text"), F.size(F.split("__text", "\n", -1)).cast("long").alias("n_lines"), F.coalesce(n_dropped, F.lit(0).cast("long")).alias("n_dropped"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    return apply_bitmaps(docs, line_bitmaps(docs))


ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) > 1),
d AS (SELECT k.*, f.first IS NOT NULL AND k.doc_id > f.first AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

"""What several operators share: input shaping, shared folders, materialising."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """Only doc_id (long) and text (string, null as empty), whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that the whole cluster shares (spark.checkpoint.dir); where that is unset a local one, and an error if the master is not local."""
    base = spark.conf.get("spark.checkpoint.dir", "") or (spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None) if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = "file://" + os.path.join(tempfile.gettempdir(), "corvina-checkpoints")
    return f"{base.rstrip('/')}/corvina-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read back: lineage is cut, and a lost executor costs no recomputation."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

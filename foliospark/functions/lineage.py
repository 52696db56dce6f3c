"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: An Arrow batch holds about so many bytes at most.
BATCH_BYTES = 32 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """Keeps the Arrow batches of a session to BATCH_BYTES, or what is set if that is less; returns df."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(name).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where none is set, a local folder on a local master and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: it is computed once and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

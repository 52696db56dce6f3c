"""What the operators of this subpackage share: tables, cut lineage, fold numbers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts can be long: an Arrow batch holds so many rows, and about so many bytes, at most.
BATCH_ROWS, BATCH_BYTES = 256, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); where none is set, a local one on a local master and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: it survives lost executors, and the plan starts anew."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def short_batches(df: DataFrame) -> DataFrame:
    """Keeps the Arrow batches of a session small enough for long texts, always by the same limits (smaller ones that are set stay); returns df."""
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(f"spark.sql.execution.arrow.{name}").rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    return df


def fold(key: str, n: int) -> Column:
    """crc32 of a key's text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n

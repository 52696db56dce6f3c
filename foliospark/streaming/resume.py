"""Chunks that arrive as files, planned against a growing cache: the resume rule in a stream.

The stream only brings the rows; each micro-batch is planned by the same batch operator. What a batch plans is
written to the cache under its number before it is handled, and a batch is planned against the batches before
it alone, which keyed state remembers. So a batch that is repeated after a crash plans the same rows again under the same number: rows are
handled at least once, none is lost, and a handler that writes by batch number has each once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliospark.operators.runs import pending_chunks

KEY = ("text_hash", "mode", "fingerprint", "chunk_index")


def read_chunk_stream(spark: SparkSession, folder: str, schema: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)


def plan_stream(chunks: DataFrame, cache_path: str, checkpoint: str, handle: Callable[[DataFrame, int], None], max_chunks: int | None = None) -> StreamingQuery:
    """Adds each micro-batch's planned keys to the cache table, then runs handle(planned rows, batch number); stops when the files are done.

    Without max_chunks each key is planned when it first comes, and Spark's keyed state knows the keys before: a batch reads no cache, however long the
    stream runs. With max_chunks a key may be left for a later batch, so what was planned is read from the cache, which must then begin with the stream.
    """
    stream = chunks.dropDuplicates(list(KEY)) if max_chunks is None else chunks

    def each(batch: DataFrame, batch_id: int) -> None:
        if max_chunks is None:
            planned = batch.withColumn("status", F.lit("planned")).persist()
        else:
            planned = pending_chunks(batch.dropDuplicates(list(KEY)), planned_before(batch, cache_path, batch_id), max_chunks).where(F.col("status") == "planned").persist()
        planned.select(*KEY).write.mode("overwrite").parquet(f"{cache_path}/batch={batch_id}")
        handle(planned, batch_id)
        planned.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def planned_before(batch: DataFrame, cache_path: str, batch_id: int) -> DataFrame:
    """The keys that batches before this one planned."""
    try:
        return batch.sparkSession.read.parquet(cache_path).where(F.col("batch") < batch_id).select(*KEY)
    except Exception as e:  # the first batch has no cache yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return batch.select(*KEY).limit(0)

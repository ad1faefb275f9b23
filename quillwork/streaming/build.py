"""A resumable build: a file stream cut into batches, each batch a committed shard."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: StructType, files_a_batch: int = 1) -> DataFrame:
    """A stream over the Parquet files of a folder, or over one file (file streams take folders alone)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch)
    folder, _, name = path.rstrip("/").rpartition("/")
    if any(f.rstrip("/").endswith(f"/{name}") for f in spark.read.schema(schema).parquet(path).inputFiles()):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def build(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, stop_after: int | None = None) -> int:
    """Run transform over all that the stream has now, batch by batch; returns the batches of this run.

    Each batch overwrites its own folder under target, so a batch that runs again after a stop leaves no second copy. With the
    same checkpoint a later call goes on where this one ended. stop_after ends the run after so many batches, as a lost
    driver would.
    """
    done = []

    def write(batch: DataFrame, number: int) -> None:
        if stop_after is not None and len(done) >= stop_after:
            raise InterruptedError(f"stopped before batch {number}")
        transform(batch).write.mode("overwrite").parquet(f"{target}/shard={number}")
        done.append(number)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if stop_after is None or len(done) < stop_after:
            raise
    return len(done)


def built(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums by window and type, with a watermark: the same plan for a table and for a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))

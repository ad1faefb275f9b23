"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder of this session where that is unset and the master is local (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.getCheckpointDir() is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quillwork-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def stash(df: DataFrame, name: str) -> DataFrame:
    """df written as a table of the shared folder and read back: computed once, whatever reads it, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/quillwork/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a table that stash made, once nothing reads it any more."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)

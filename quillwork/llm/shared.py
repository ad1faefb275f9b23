"""What the operators of this package share: tables in the shared folder, words, hashes, text slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points of a slice of texts that is worked on at once in Python; bounds a worker's memory.
SLICE_CHARS = 2_000_000
LOWER = (("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("abcdefghijklmnopqrstuvwxyz"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset and the master
    is local (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.getCheckpointDir() is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quillwork-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillwork/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stashed = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stashed tables that nothing needs any more; later tables have been written, so no lineage leads back to them."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stashed)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now: it does so when the driver's JVM collects its garbage."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Give freed memory back to the system, where the C library can: workers live on between tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    free = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if free:
        free(0)


def ascii_lower(column):
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, *LOWER)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words [^\\x20\\x09-\\x0D]+ as UTF-8: bytes.lower and bytes.split are exactly that."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def slices(texts: Iterable[str | None], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds [a, b) of consecutive slices of about so many code points; a text is never cut."""
    a = n = 0
    k = -1
    for k, text in enumerate(texts):
        n += len(text) if text else 1
        if n >= chars:
            yield a, k + 1
            a, n = k + 1, 0
    if a <= k:
        yield a, k + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor, shift and multiply), on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Codes(dict):
    """Word -> code, by first appearance; calling map() over a list costs one dict access a word."""

    def __missing__(self, word):
        self[word] = code = len(self)
        return code

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes, uint64."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class WordHashes:
    """Hashes of all words of a slice; remembers the words seen by this worker, up to a bound, then starts afresh."""

    def __init__(self, most: int = 400_000):
        self.most, self.codes, self.hashes = most, Codes(), np.zeros(0, np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.codes) > self.most:
            self.codes, self.hashes = Codes(), np.zeros(0, np.uint64)
        at = self.codes.of(words)
        if len(self.codes) > len(self.hashes):
            fresh = list(self.codes)[len(self.hashes) :]
            self.hashes = np.concatenate([self.hashes, hash_words(fresh)])
        return self.hashes[at]

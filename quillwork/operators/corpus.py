"""Corpus operators: chunks, exact duplicates, contiguous ids, manifests, splits and samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from pyspark.sql.window import Window

from quillwork.functions.text import normalize, sha256, windows

#: Rows of an order-key bin in contiguous_ids.
ID_BIN = 4096


def chunk_documents(docs: DataFrame, width: int, min_chars: int = 1, order: str = "doc_id") -> DataFrame:
    """One row a chunk: the columns of docs but text, then chunk_index, chunk_count, text, char_count, content_hash.

    Texts shorter than min_chars go before, chunks shorter than it after they are cut and numbered: index and count are those
    of the whole cut.
    """
    rest = [c for c in docs.columns if c != "text"]
    cut = docs.withColumn("text", normalize(F.col("text"))).where(F.length("text") >= min_chars)
    parts = cut.select(*rest, windows(F.col("text"), width).alias("parts"))
    out = parts.select(*rest, F.size("parts").alias("chunk_count"), F.posexplode("parts").alias("chunk_index", "text")).where(F.length("text") >= min_chars)
    return out.select(*rest, "chunk_index", "chunk_count", "text", F.length("text").alias("char_count"), sha256(F.col("text")).alias("content_hash"))


def drop_duplicates(chunks: DataFrame, order: tuple[str, ...] = ("doc_id", "chunk_index"), key: str = "content_hash") -> DataFrame:
    """The first row of each key in the given order. A minimum by struct combines before the shuffle, so a hot key is no burden."""
    rest = [c for c in chunks.columns if c not in (*order, key)]
    first = F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("row")
    return chunks.groupBy(key).agg(first).select(key, "row.*").select(*chunks.columns)


def contiguous_ids(rows: DataFrame, order: tuple[str, ...], bin_of: Column, name: str = "ord") -> DataFrame:
    """rows numbered from 1 in an order, without a single-task sort: rows are numbered within bins of the first order
    column, and a bin starts where the counts of those before it end. bin_of must not fall as the order rises."""
    binned = rows.withColumn("_bin", bin_of)
    counts = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_bin", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_bin").orderBy(*order))
    return binned.join(starts, "_bin").withColumn(name, rank + F.col("_before")).drop("_bin", "_before")


def corpus_id(ord_: Column) -> Column:
    return F.format_string("corpus_%09d", ord_)


def manifest(chunks: DataFrame, by: str) -> DataFrame:
    """Rows, code points and documents still in the corpus, for each value of a column."""
    return chunks.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), F.sum("char_count").cast("long").alias("char_count"), F.countDistinct("doc_id").alias("source_count"))


def report(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of build counters: what was seen, what was empty, what was cut, what was a duplicate."""
    seen = docs.agg(F.count(F.lit(1)).alias("sources_seen"), F.sum(F.when(F.length(normalize(F.col("text"))) < 1, 1).otherwise(0)).cast("long").alias("sources_empty"))
    cut = chunks.agg(F.count(F.lit(1)).alias("rows_before_dedup"), F.countDistinct("content_hash").alias("rows"), F.countDistinct("doc_id").alias("sources_included"))
    both = seen.join(cut)  # one row each
    return both.select("*", (F.col("rows_before_dedup") - F.col("rows")).alias("duplicates_removed"), F.when(F.col("sources_seen") > F.col("sources_included"), "warn").otherwise("pass").alias("status"))


def normalize_split(value: Column) -> Column:
    """Split names in lower case; short names of validation spelt out; null or empty is unspecified."""
    name = F.lower(F.trim(value))
    return F.when(name.isin("val", "valid"), "validation").when(name.isNull() | (name == ""), "unspecified").otherwise(name)


def filter_prompts(prompts: DataFrame, split: str | None = None, tags: tuple[str, ...] = (), limit: int | None = None, order: str = "ord") -> DataFrame:
    """Prompts of a split that carry all tags, the first `limit` of them."""
    out = prompts if split is None else prompts.where(F.col("split") == split)
    for tag in tags:
        out = out.where(F.array_contains("tags", tag))
    return out if limit is None else out.orderBy(order).limit(limit)


def prompt_manifest(prompts: DataFrame) -> DataFrame:
    """Prompts and sorted distinct tags of each split that has any."""
    tags = prompts.select("split", F.explode_outer("tags").alias("tag")).groupBy("split").agg(F.concat_ws(",", F.sort_array(F.collect_set("tag"))).alias("tags"))
    return prompts.groupBy("split").agg(F.count(F.lit(1)).alias("prompts")).join(tags, "split")


def round_robin(ord_: Column, names: tuple[str, ...] = ("train", "calibration", "final_test")) -> Column:
    """A split by rank modulo the number of splits."""
    out = F.lit(names[-1])
    for k, name in enumerate(names[:-1]):
        out = F.when(F.pmod(ord_, F.lit(len(names))) == k, name).otherwise(out)
    return out


def seeded_split(rows: DataFrame, validation: float, test: float, seed: int, key: str = "id") -> DataFrame:
    """A random split in hash order: a share of validation and of test rows (one at least where the share is above 0), the rest
    train, which always keeps one row."""
    n = rows.count()
    n_test = min(max(1, int(n * test)) if test > 0 else 0, max(0, n - 1))
    n_validation = min(max(1, int(n * validation)) if validation > 0 else 0, max(0, n - 1 - n_test))
    hashed = rows.withColumn("_h", F.xxhash64(key, F.lit(seed)))
    # The cut points come from the two bounded ends of the hash order, not from a global sort of the rows.
    cuts = [hashed.orderBy("_h", key).limit(k).agg(F.max("_h")).first()[0] if k else None for k in (n_test, n_test + n_validation)]
    low = F.lit(False) if cuts[0] is None else F.col("_h") <= cuts[0]
    mid = F.lit(False) if cuts[1] is None else F.col("_h") <= cuts[1]
    return hashed.withColumn("split", F.when(low, "test").when(mid, "validation").otherwise("train")).drop("_h")


def shard_of(ord_: Column, size: int) -> tuple[Column, Column]:
    """Shard and row in the shard of a 0-based rank."""
    return F.floor(ord_ / size).cast("long"), F.pmod(ord_, F.lit(size)).cast("long")


def stratified_sample(rows: DataFrame, stratum: str, order: tuple[str, ...], size: int) -> DataFrame:
    """Largest-remainder allocation of `size` rows to strata, the first rows of each in order.

    Strata are few against rows, so the allocation is a window over counts; ties of remainders go to the lesser stratum.
    """
    counts = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    quota = counts.withColumn("_q", F.lit(size) * F.col("_n") / total).withColumn("_a", F.floor("_q"))
    left = F.lit(size) - F.sum("_a").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy((F.col("_q") - F.col("_a")).desc(), stratum))
    given = quota.withColumn("_slots", F.col("_a") + F.when(rank <= left, 1).otherwise(0)).select(stratum, "_slots")
    return rows.join(given, stratum).withColumn("_rank", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where("_rank <= _slots").drop("_rank", "_slots")


def group_tokens(text: Column, width: int, vocabulary: int) -> Column:
    """Code point plus position, modulo the vocabulary, for each position; 0 beyond the text."""
    at = lambda k: F.when(k < F.length(text), F.pmod(F.ascii(F.substr(text, k + 1, F.lit(1))) + k, F.lit(vocabulary))).otherwise(F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), at)


def byte_tokens(rows: DataFrame, text: str = "text", name: str = "ids", most: int | None = None) -> DataFrame:
    """rows with the UTF-8 bytes of a text plus one, the first `most` of them if that is given; a null text has none."""
    at, names = rows.columns.index(text), [*rows.columns, name]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)[:most].astype(np.int32) + 1 for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=names)

    return rows.mapInArrow(work, StructType(list(rows.schema.fields)).add(name, ArrayType(IntegerType())))

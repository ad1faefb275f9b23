"""Packaging: digests of ordered collections, count-sharded payloads, deterministic archives and manifests."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import tarfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.functions.text import sha256

#: Rows of one leaf of a collection's digest tree.
LEAF = 1024


def canonical_json(value, ascii_only: bool = False) -> str:
    """Sorted keys, no spaces."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only)


def digest(value, domain: str | None = None, version: int = 1) -> str:
    """The SHA-256 of a value's canonical JSON, in a domain of its own if one is named."""
    head = f"quillwork:{domain}:{version}\n" if domain else ""
    return "sha256:" + hashlib.sha256((head + canonical_json(value)).encode()).hexdigest()


def collection_root(rows: DataFrame, group: list[str], order: str, item: str) -> DataFrame:
    """(group, leaves, items, root): a digest of the items of each group in order. Leaves hold the rows of LEAF consecutive order
    values, so that no task holds more than one leaf's items or one group's leaf digests."""
    leaves = rows.groupBy(*group, F.floor(F.col(order) / LEAF).alias("_leaf")).agg(F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("i")))).alias("_items"))
    leaves = leaves.select(*group, "_leaf", "_n", F.sha2(F.array_join(F.transform("_items", lambda x: x["i"]), "\n").cast("binary"), 256).alias("_digest"))
    tops = leaves.groupBy(*group).agg(F.count(F.lit(1)).alias("leaves"), F.sum("_n").alias("items"), F.array_sort(F.collect_list(F.struct("_leaf", "_digest"))).alias("_list"))
    return tops.select(*group, "leaves", "items", sha256(F.array_join(F.transform("_list", lambda x: x["_digest"]), "\n")).alias("root"))


def shard_rows(rows: DataFrame, ord_: Column, capacity: int) -> DataFrame:
    """rows with the shard and the row in the shard of their 0-based rank."""
    return rows.withColumn("shard_id", F.floor(ord_ / capacity).cast("long")).withColumn("row_in_shard", F.pmod(ord_, F.lit(capacity)).cast("long"))


def shard_manifest(rows: DataFrame, key: str) -> DataFrame:
    """First and last rank, rows and payload bytes of each shard."""
    return rows.groupBy("shard_id").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows"))


def write_shards(rows: DataFrame, path: str) -> None:
    """Shards as partitions of a Parquet table; Spark's commit makes each write whole or nothing."""
    rows.repartition("shard_id").sortWithinPartitions("shard_id", "row_in_shard").write.partitionBy("shard_id").mode("errorifexists").parquet(path)


def pack_archive(root: str, target: str, compress: bool = True) -> str:
    """A tar archive of a folder whose bytes depend on its files alone: sorted members, no times, no owners. Returns its digest."""
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w", format=tarfile.USTAR_FORMAT) as archive:
        for path in sorted(p for p in Path(root).rglob("*") if p.is_file()):
            info = tarfile.TarInfo(path.relative_to(root).as_posix())
            info.size = path.stat().st_size
            with path.open("rb") as f:
                archive.addfile(info, f)
    data = gzip.compress(plain.getvalue(), mtime=0) if compress else plain.getvalue()
    Path(target).write_bytes(data)
    return "sha256:" + hashlib.sha256(data).hexdigest()


def safe_member(name: str) -> bool:
    """A relative path that stays within its root."""
    parts = name.replace("\\", "/").split("/")
    return bool(name) and not name.startswith(("/", "\\")) and ":" not in parts[0] and ".." not in parts and "" not in parts[:-1]


def unpack_archive(archive: str, root: str) -> list[str]:
    """Unpack regular files alone; any other member, or a path that leaves the root, is an error before anything is written."""
    with tarfile.open(archive) as tar:
        members = tar.getmembers()
        for m in members:
            if not m.isfile() or not safe_member(m.name):
                raise ValueError(f"unsafe archive member: {m.name}")
        for m in members:
            out = Path(root) / m.name
            out.parent.mkdir(parents=True, exist_ok=True)
            out.write_bytes(tar.extractfile(m).read())
    return [m.name for m in members]


def tree_manifest(spark, root: str) -> DataFrame:
    """(path, size, digest) of all files under a folder, by Spark's binary reader."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.col("path"), F.col("length").alias("size"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("digest"))

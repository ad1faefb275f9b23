from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillwork.operators import audit, package
from quillwork.streaming import build as stream

ROOT = Path(__file__).resolve().parents[1]


def test_surfaces_and_linkage_name_what_differs(spark):
    left = spark.createDataFrame([("a", 1, 5), ("b", 1, 6), ("c", 1, 7)], "id string, pos int, k int")
    right = spark.createDataFrame([("a", 1, 5), ("b", 1, 9), ("d", 1, 1)], "id string, pos int, k int")
    assert {r["id"]: r["status"] for r in audit.surface_diff(left, right, ["id", "pos"]).collect()} == {"a": "matched", "b": "matched", "c": "missing", "d": "extra"}
    assert {r["id"]: r["reasons"] for r in audit.linkage_audit(left, right, ["id", "pos"], ["k"]).collect()} == {"b": "k_mismatch", "c": "payload_missing", "d": "record_missing"}


def test_top_k_check_counts_each_fault(spark):
    schema = "top_ids array<int>, top_probs array<double>, top_mass double, tail_mass double, entropy double"
    rows = [([0, 1], [0.6, 0.3], 0.9, 0.1, 1.0), ([0, 9], [0.6, 0.3], 0.9, 0.1, 1.0), ([1, 1], [0.3, 0.6], 0.9, 0.5, -1.0)]
    got = {r["check"]: r["violations"] for r in audit.check_top_k(spark.createDataFrame(rows, schema), 8).collect()}
    assert got == {"id_out_of_range": 1, "duplicate_id": 1, "not_descending": 1, "mass_out_of_range": 0, "mass_not_one": 1, "negative_entropy": 1}


def test_range_lookup_over_uneven_ranges(spark):
    ranges = spark.createDataFrame([(0, 0, 3), (1, 3, 50), (2, 50, 51)], "r int, a long, b long")
    points = spark.range(0, 55).withColumnRenamed("id", "p")
    got = {r["p"]: r["r"] for r in audit.range_lookup(points, ranges, "p", "a", "b", 10).collect()}
    assert got == {p: 0 if p < 3 else 1 if p < 50 else 2 for p in range(51)}


def test_overlap_of_named_sets(spark):
    sets = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2), ("y", 3), ("z", 9)], "name string, k int")
    assert [tuple(r) for r in audit.overlap(sets, "name", ["k"]).collect()] == [("x", "y", 1, 3, round(1 / 3, 6))]


def test_archive_bytes_depend_on_files_alone(tmp_path):
    src = tmp_path / "src"
    (src / "d").mkdir(parents=True)
    (src / "d/b.txt").write_text("b")
    (src / "a.txt").write_text("a")
    one = package.pack_archive(str(src), str(tmp_path / "1.tgz"))
    (src / "a.txt").touch()
    assert package.pack_archive(str(src), str(tmp_path / "2.tgz")) == one
    assert sorted(package.unpack_archive(str(tmp_path / "1.tgz"), str(tmp_path / "out"))) == ["a.txt", "d/b.txt"]
    assert (tmp_path / "out/d/b.txt").read_text() == "b"


@pytest.mark.parametrize("name", ["/a", "../a", "a/../b", "C:/x", "", "a//b"])
def test_unsafe_members(name):
    assert not package.safe_member(name)


def test_collection_root_follows_order_and_content(spark):
    rows = spark.createDataFrame([("g", k, f"i{k}") for k in range(3000)], "g string, o long, i string")
    root = lambda df: package.collection_root(df, ["g"], "o", "i").first()["root"]
    assert root(rows) == root(rows.repartition(5)) != root(rows.withColumn("i", F.when(F.col("o") == 7, "x").otherwise(F.col("i"))))
    assert package.digest({"b": 1, "a": [2]}) == package.digest({"a": [2], "b": 1}) != package.digest({"a": [2], "b": 1}, "domain")


def test_shards_hold_their_capacity(spark, tmp_path):
    rows = package.shard_rows(spark.range(10), F.col("id"), 4)
    package.write_shards(rows, f"{tmp_path}/s")
    assert [tuple(r)[1:] for r in package.shard_manifest(spark.read.parquet(f"{tmp_path}/s"), "id").orderBy("shard_id").collect()] == [(0, 3, 4), (4, 7, 4), (8, 9, 2)]


def test_stream_stops_resumes_and_equals_the_batch(spark, tmp_path):
    spark.range(100).repartition(5).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    go = lambda stop: stream.build(stream.read_stream(spark, f"{tmp_path}/in", schema), lambda b: b.select((F.col("id") * 2).alias("x")), f"{tmp_path}/out", f"{tmp_path}/state", stop)
    assert go(2) == 2 and go(None) >= 3 and go(None) == 0
    assert sorted(r["x"] for r in stream.built(spark, f"{tmp_path}/out").collect()) == [2 * k for k in range(100)]


def test_entry_works_without_the_optional_subpackage(tmp_path):
    code = "import sys; sys.modules['quillwork.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'corpus_exact_dedup' in q and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

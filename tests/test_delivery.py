from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from quillwork.operators import delivery

COORDINATE = "example_id string, position int"


def test_passports_agree_with_claims(spark):
    claims = spark.createDataFrame([("a", 0, 1), ("b", 0, 1), ("c", 0, 1), ("d", 0, None), ("e", 0, 2)], f"{COORDINATE}, mode_id int")
    passports = spark.createDataFrame([("a", 0, 1, "linked"), ("b", 0, 2, "linked"), ("d", 0, 3, None), ("e", 0, 2, "missing")], f"{COORDINATE}, corridor_mode_id int, corridor_assignment_status string")
    got = {r["example_id"]: (r["passport_status"], r["corridor_mode_id"], r["corridor_assignment_status"]) for r in delivery.attach_passports(claims, passports).collect()}
    assert got == {"a": ("ok", 1, "linked"), "b": ("mode_mismatch", 1, "linked"), "c": ("passport_missing", 1, "linked"), "d": ("ok", 3, "not_applicable"), "e": ("not_linked", 2, "linked")}


def test_grid_against_brute_force(spark):
    rng = random.Random(3)
    lengths = {f"e{k}": rng.randrange(0, 4) for k in range(30)}
    cells = [(f"e{rng.randrange(33)}", rng.randrange(-1, 4)) for _ in range(120)] + [("full", k) for k in range(3)]
    lengths["full"] = 3
    want = {}
    for e in {*lengths, *(c[0] for c in cells)}:
        own, grid = [p for x, p in cells if x == e], set(range(lengths.get(e, 0)))
        row = (len(grid - set(own)), len(set(own) - grid), len(own) - len(set(own)))
        if any(row):
            want[e] = (lengths.get(e), *row)
    got = delivery.grid_audit(spark.createDataFrame(cells, COORDINATE), spark.createDataFrame(list(lengths.items()), "example_id string, length int"))
    assert {r["example_id"]: tuple(r)[1:] for r in got.collect()} == want and "full" not in want


def test_collections_name_what_differs(spark):
    table = lambda rows: spark.createDataFrame(rows, f"{COORDINATE}, selection_index int")
    found = {"obligation": table([("a", 0, 0), ("b", 0, 1), ("c", 0, 2)]), "passport": table([("a", 0, 0), ("b", 0, 1), ("b", 0, 1), ("d", 0, None)]), "payload": table([("a", 0, 0), ("b", 0, 7), ("d", 0, 3)])}
    got = {r["example_id"]: r["reasons"] for r in delivery.collections_agree(found, delivery.COORDINATE, ["selection_index"]).collect()}
    assert got == {"b": "passport_duplicate,selection_index_differs", "c": "passport_missing,payload_missing", "d": "obligation_missing,selection_index_differs"}
    assert delivery.collections_agree({"x": table([]), "y": table([])}, delivery.COORDINATE, ["selection_index"]).count() == 0


def test_ranked_selections_place_by_place(spark):
    side = lambda rows: spark.createDataFrame(rows, f"rank int, {COORDINATE}")
    got = delivery.compare_ranked(side([(1, "a", 0), (2, "b", 1), (3, "c", 0)]), side([(1, "a", 0), (2, "b", 2), (4, "d", 0)]))
    assert {r["rank"]: r["status"] for r in got.collect()} == {1: "matched", 2: "differs", 3: "left_only", 4: "right_only"}


def test_shard_digests_follow_order(spark):
    rows = spark.createDataFrame([(k // 4, k % 4, f"h{k}") for k in range(10)], "shard_id long, row_in_shard long, item string")
    digests = {r["shard_id"]: (r["rows"], r["shard_sha256"]) for r in delivery.shard_digests(rows.repartition(3), "item").collect()}
    turned = {r["shard_id"]: r["shard_sha256"] for r in delivery.shard_digests(rows.withColumn("row_in_shard", 3 - F.col("row_in_shard")), "item").collect()}
    assert [digests[k][0] for k in range(3)] == [4, 4, 2] and all(turned[k] != digests[k][1] for k in range(3))
    index = delivery.index_rows(rows, delivery.shard_digests(rows.where("shard_id < 2"), "item"))
    assert index.count() == 10 and index.where("shard_sha256 is null").count() == 2


def test_obligations_and_supply(spark):
    rows = [("a", 0, "corridor", "1"), ("a", 0, "global", "x"), ("b", 0, "global", "x"), ("b", 0, "global", "y"), ("c", 1, "corridor", "2")]
    duties = spark.createDataFrame(rows, f"{COORDINATE}, role string, source_id string")
    assert tuple(delivery.obligation_summary(duties).first()) == (3, 2, 2, 2, 5)
    assert tuple(delivery.supply_diagnostics(duties, 5).first()) == (2, 2, 1, 3, 1, round(1 / 3, 6), 2, "insufficient_eligible_unique_candidates")
    assert tuple(delivery.supply_diagnostics(duties.limit(0), 0).first()) == (0, 0, 0, 0, 0, 0.0, 0, None)


def test_merge_is_the_same_whatever_the_workers(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 3), f"s{rng.randrange(3)}", k) for k in range(200)]
    table = lambda x: spark.createDataFrame(x, "score double, source string, id int")
    want = [r[2] for r in sorted(rows, key=lambda r: (-r[0], r[1], r[2]))]
    for cut in (0, 77):
        got = delivery.merge_candidates([table(rows[cut:]), table(rows[:cut])], "score", ("source", "id"))
        assert [r["id"] for r in got.orderBy("merged_rank").collect()] == want


def test_lengths_entropies_and_timings(spark):
    rows = spark.createDataFrame([(99, None), (-1, [1]), (None, [1, 1, 0]), (None, None)], "length int, mask array<int>")
    assert [r[0] for r in rows.select(delivery.valid_length(F.col("length"), F.col("mask"), 8)).collect()] == [8, 0, 2, 8]
    pairs = spark.createDataFrame([(1.0, 1.00390625), (1.0, 1.004), (None, 1.0), (float("inf"), float("inf"))], "a double, b double")
    assert [r[0] for r in pairs.select(delivery.entropy_close(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]
    runs = {"a": [5.0, 9.0, 7.0], "b": [0.0, 0.0, 0.0], "c": [1.0, 2.0]}
    table = spark.createDataFrame([(k, v) for k, vs in runs.items() for v in vs], "step string, s double")
    got = {r["step"]: tuple(r)[1:] for r in delivery.timing_summary(table, ["step"], "s").collect()}
    assert got == {k: (len(v), statistics.median(v), max(v) - min(v), 0.0 if k == "b" else (max(v) - min(v)) / statistics.median(v)) for k, v in runs.items()}
    faster = spark.createDataFrame([("a", 1.0), ("a", 1.5), ("a", 1.25)], "step string, s double")
    slow, quick = (delivery.timing_summary(t, ["step"], "s") for t in (table, faster))
    assert not delivery.timing_verdict(slow, quick, ["step"]).first()["improved"]  # the spread is 4
    assert delivery.timing_verdict(slow, quick, ["step"], noise=1.0).first()["improved"] and delivery.timing_verdict(quick, slow, ["step"], noise=1.0).first()["regressed"]


def test_bucket_check_counts_each_fault(spark):
    good = ([0.1, 0.0], [2, 0], [-2.0, 0.0], 0.9, 0.1)
    rows = [good, ([0.1, 0.0], [2, 0], [-2.0, -1.0], 0.9, 0.1), ([0.1, 0.0], [3, -1], [2.0, 0.0], 0.9, 0.1), ([-0.1, float("nan")], [1, 0], [-1.0, 0.0], 0.9, 0.1)]
    schema = "bucket_mass array<double>, bucket_count array<long>, bucket_logp array<double>, top_mass double, tail_mass double"
    got = {r["check"]: r["violations"] for r in delivery.check_buckets(spark.createDataFrame(rows, schema), 2).collect()}
    assert got == {"count_negative": 1, "mass_not_finite": 1, "mass_negative": 1, "mean_not_finite": 0, "empty_bucket_mean": 1, "mean_positive": 1, "count_sum": 1, "tail_mass_differs": 1, "mass_not_one": 1}


@pytest.mark.parametrize("edges", [["1.0"], ["1", "0.5", "0.5", "0"], ["0.9", "0"], ["1", "0.1"], ["1", "nan", "0"]])
def test_edges_that_are_refused(edges):
    with pytest.raises(ValueError):
        delivery.bucket_edges(edges)
    assert delivery.bucket_edges(["1.0", "0.1", "0.0"]) == (1.0, 0.1, 0.0)

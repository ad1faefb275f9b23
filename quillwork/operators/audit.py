"""Checks and comparisons. A check is a table of violations (empty: pass); a comparison is a full outer join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def verdict(blockers: Column, warnings: Column) -> Column:
    return F.when(blockers > 0, "fail").when(warnings > 0, "warn").otherwise("pass")


def check_corpus(rows: DataFrame) -> DataFrame:
    """(check, violations) for rows(corpus_id, text, content_hash, char_count, chunk_index, chunk_count)."""
    from quillwork.functions.text import sha256

    bad = rows.agg(
        F.sum((F.col("text").isNull() | (F.length("text") == 0)).cast("long")).alias("empty_text"), F.sum((sha256(F.col("text")) != F.col("content_hash")).cast("long")).alias("hash_mismatch"),
        F.sum((F.length("text") != F.col("char_count")).cast("long")).alias("length_mismatch"), F.sum((~F.col("chunk_index").between(0, F.col("chunk_count") - 1)).cast("long")).alias("chunk_out_of_range"),
    )
    names = ["empty_text", "hash_mismatch", "length_mismatch", "chunk_out_of_range"]
    wide = bad.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.coalesce(F.col(n), F.lit(0)).alias("violations")) for n in names))).alias("c")).select("c.*")
    again = rows.groupBy("corpus_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("violations")).select(F.lit("duplicate_id").alias("check"), "violations")
    return wide.unionByName(again)


def check_top_k(rows: DataFrame, vocabulary: int, slack: float = 1e-3) -> DataFrame:
    """(check, violations) for rows(top_ids, top_probs, top_mass, tail_mass, entropy): ids in range and distinct, falling
    probabilities, masses that add up to one, and no negative entropy."""
    falling = F.forall(F.sequence(F.lit(2), F.size("top_probs")), lambda k: F.element_at("top_probs", k - 1) >= F.element_at("top_probs", k))
    checks = {
        "id_out_of_range": ~F.forall("top_ids", lambda x: (x >= 0) & (x < vocabulary)), "duplicate_id": F.size(F.array_distinct("top_ids")) < F.size("top_ids"), "not_descending": (F.size("top_probs") > 1) & ~falling,
        "mass_out_of_range": ~F.col("top_mass").between(0, 1 + slack) | ~F.col("tail_mass").between(0, 1 + slack), "mass_not_one": F.abs(F.col("top_mass") + F.col("tail_mass") - 1) > slack, "negative_entropy": F.col("entropy") < 0,
    }
    bad = rows.agg(*(F.sum(c.cast("long")).alias(n) for n, c in checks.items()))
    return bad.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.coalesce(F.col(n), F.lit(0)).alias("violations")) for n in checks))).alias("c")).select("c.*")


def surface_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, or that a side has more than once: (keys, left_n, right_n, status)."""
    count = lambda t, n: t.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    both = count(left, "left_n").join(count(right, "right_n"), keys, "full_outer").na.fill(0, ["left_n", "right_n"])
    status = F.when(F.col("right_n") == 0, "missing").when(F.col("left_n") == 0, "extra").when((F.col("left_n") > 1) | (F.col("right_n") > 1), "duplicate").otherwise("matched")
    return both.select(*keys, "left_n", "right_n", status.alias("status"))


def linkage_audit(records: DataFrame, payloads: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row a key that doesn't agree on both sides, with the reasons: absent on a side, or the names of differing fields."""
    left = records.select(*keys, *(F.col(f).alias(f"_l_{f}") for f in fields), F.lit(1).alias("_l"))
    right = payloads.select(*keys, *(F.col(f).alias(f"_r_{f}") for f in fields), F.lit(1).alias("_r"))
    both = left.join(right, keys, "full_outer")
    differ = [F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull() & ~F.col(f"_l_{f}").eqNullSafe(F.col(f"_r_{f}")), f"{f}_mismatch") for f in fields]
    reasons = F.array_compact(F.array(F.when(F.col("_r").isNull(), "payload_missing"), F.when(F.col("_l").isNull(), "record_missing"), *differ))
    return both.withColumn("reasons", F.concat_ws(",", reasons)).where("reasons <> ''").select(*keys, "reasons")


def numeric_diff(left: Column, right: Column, rtol: float = 1e-4, atol: float = 1e-5) -> list[Column]:
    """Aggregates over pairs of numbers: how many, largest and mean absolute and largest relative difference, share within
    atol + rtol * |left|, and numbers that aren't finite."""
    gap = F.abs(left - right)
    odd = left.isNull() | right.isNull() | F.isnan(left) | F.isnan(right)
    return [
        F.count(F.lit(1)).alias("n"), F.round(F.max(gap), 9).alias("max_abs"), F.round(F.avg(gap), 9).alias("mean_abs"), F.round(F.max(F.when(F.abs(left) > 1e-6, gap / F.abs(left))), 6).alias("max_rel"),
        F.round(F.avg((gap <= atol + rtol * F.abs(left)).cast("double")), 6).alias("within"), F.sum(odd.cast("long")).alias("n_odd"),
    ]


def overlap(sets: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """(left, right, shared, either, jaccard) of each two named sets of keys that share a key. Joined on the keys, so work
    follows memberships, not pairs of sets."""
    distinct = sets.select(name, *keys).distinct()
    sizes = distinct.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    a, b = distinct.withColumnRenamed(name, "left"), distinct.withColumnRenamed(name, "right")
    shared = a.join(b, keys).where("left < right").groupBy("left", "right").agg(F.count(F.lit(1)).alias("shared"))
    out = shared.join(sizes.select(F.col(name).alias("left"), F.col("n").alias("_l")), "left").join(sizes.select(F.col(name).alias("right"), F.col("n").alias("_r")), "right")
    either = F.col("_l") + F.col("_r") - F.col("shared")
    return out.select("left", "right", "shared", either.alias("either"), F.round(F.col("shared") / either, 6).alias("jaccard"))


def range_lookup(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, width: int) -> DataFrame:
    """points joined to the ranges [start, end) that hold them, by an equi-join on bins of a fixed width: a range is listed in
    each bin that it touches."""
    listed = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    binned = points.withColumn("_bin", F.floor(F.col(at) / width))
    return binned.join(listed, "_bin").where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin")

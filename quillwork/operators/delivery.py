"""Delivery of a selection: passports, grids, collections that must agree, budgets, coverage and byte accounts as tables."""

from __future__ import annotations

from functools import reduce as fold

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.operators.corpus import contiguous_ids

COORDINATE = ["example_id", "position"]

#: The step within which two entropies count as equal, and the least denominator of a relative delta.
ENTROPY_STEP, LEAST_DENOMINATOR = 0.00390625, 1e-8


def attach_passports(claims: DataFrame, passports: DataFrame, keys: list[str] = COORDINATE) -> DataFrame:
    """claims(keys, mode_id) with the mode and assignment status that their passports(keys, corridor_mode_id,
    corridor_assignment_status) give, and passport_status: ok, passport_missing, mode_mismatch or not_linked.

    A claim without a mode is not_applicable unless its passport says otherwise. Passports are unique by key.
    """
    both = claims.join(passports.withColumn("_there", F.lit(True)), keys, "left")
    mode, found = F.col("mode_id"), F.col("corridor_mode_id")
    status = F.when(F.col("_there").isNull(), "passport_missing").when(mode.isNotNull() & found.isNotNull() & (mode != found), "mode_mismatch")
    status = status.when(mode.isNotNull() & (F.coalesce("corridor_assignment_status", F.lit("linked")) != "linked"), "not_linked").otherwise("ok")
    linked = F.when(mode.isNotNull(), "linked").otherwise(F.coalesce("corridor_assignment_status", F.lit("not_applicable")))
    return both.select(*claims.columns, F.coalesce(mode, found).alias("corridor_mode_id"), linked.alias("corridor_assignment_status"), status.alias("passport_status"))


def grid_audit(assignments: DataFrame, examples: DataFrame, key: str = "example_id", position: str = "position", length: str = "length") -> DataFrame:
    """Examples whose assignments aren't their whole grid of positions 0 to length - 1, each once: how many are missing, beyond
    the grid or repeated. An example that only assignments name has no length. Counts alone are shuffled, no grid is built."""
    cells = assignments.groupBy(key, position).agg(F.count(F.lit(1)).alias("_n"))
    both = cells.join(examples.select(key, F.col(length).cast("long").alias("length")), key, "full_outer")
    inside = F.col(position).isNotNull() & (F.col(position) >= 0) & (F.col(position) < F.coalesce("length", F.lit(0)))
    out = both.groupBy(key, "length").agg(
        F.sum(inside.cast("long")).alias("_in"), F.sum((F.col("_n").isNotNull() & ~inside).cast("long")).alias("extra"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("repeated")
    )
    out = out.withColumn("missing", F.coalesce("length", F.lit(0)) - F.col("_in"))
    return out.where("missing > 0 or extra > 0 or repeated > 0").select(key, "length", "missing", "extra", "repeated")


def collections_agree(collections: dict[str, DataFrame], keys: list[str], same: list[str]) -> DataFrame:
    """Keys that don't stand once in each of the named collections, or whose columns `same` differ between them, with reasons in
    the order of the collections, then of the columns. One shuffle by key, whatever the number of collections."""
    tagged = [t.select(*keys, *same, F.lit(k).alias("_k")) for k, t in enumerate(collections.values())]
    rows = fold(DataFrame.unionByName, tagged)
    counts = [F.sum((F.col("_k") == k).cast("long")).alias(f"_n{k}") for k in range(len(tagged))]
    # Nulls are values of their own: a struct is never null.
    spread = [F.min(F.struct(c)) != F.max(F.struct(c)) for c in same]
    found = rows.groupBy(*keys).agg(*counts, *(s.alias(f"_s_{c}") for c, s in zip(same, spread, strict=True)))
    reasons = []
    for k, name in enumerate(collections):
        reasons.append(F.when(F.col(f"_n{k}") == 0, f"{name}_missing").when(F.col(f"_n{k}") > 1, f"{name}_duplicate"))
    reasons += [F.when(F.col(f"_s_{c}"), f"{c}_differs") for c in same]
    return found.select(*keys, F.concat_ws(",", F.array_compact(F.array(*reasons))).alias("reasons")).where("reasons <> ''")


def compare_ranked(left: DataFrame, right: DataFrame, rank: str = "rank", keys: list[str] = COORDINATE) -> DataFrame:
    """Two selections place by place: matched, differs, left_only or right_only."""
    side = lambda t, n: t.select(rank, F.struct(*keys).alias(n))
    both = side(left, "_l").join(side(right, "_r"), rank, "full_outer")
    status = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").when(F.col("_l") == F.col("_r"), "matched").otherwise("differs")
    return both.select(rank, status.alias("status"), *(F.col(f"_l.{k}").alias(f"left_{k}") for k in keys), *(F.col(f"_r.{k}").alias(f"right_{k}") for k in keys))


def shard_digests(rows: DataFrame, item: str, shard: str = "shard_id", row: str = "row_in_shard") -> DataFrame:
    """(shard, rows, shard_sha256): the digest of a shard's items in row order. A shard holds a fixed number of rows."""
    held = rows.groupBy(shard).agg(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_list(F.struct(F.col(row).alias("r"), F.col(item).alias("i")))).alias("_items"))
    return held.select(shard, "rows", F.sha2(F.array_join(F.transform("_items", lambda x: x["i"]), "\n").cast("binary"), 256).alias("shard_sha256"))


def index_rows(rows: DataFrame, digests: DataFrame, shard: str = "shard_id") -> DataFrame:
    """rows with the digest of their shard; a shard without one is an error in the delivery and gives null."""
    return rows.join(digests.select(shard, "shard_sha256"), shard, "left")


def split_overlap(rows: DataFrame, key: str, split: str) -> DataFrame:
    """(left, right, shared): keys that stand in both of two splits. Splits are few, so a key's set of them is small."""
    sets = rows.groupBy(key).agg(F.array_sort(F.collect_set(split)).alias("_in")).where(F.size("_in") > 1)
    left = sets.select("_in", F.explode("_in").alias("left"))
    return left.select("left", F.explode(F.filter("_in", lambda x: x > F.col("left"))).alias("right")).groupBy("left", "right").agg(F.count(F.lit(1)).alias("shared"))


def plan_totals(plan: DataFrame, ceiling: int) -> DataFrame:
    """One row over the allocations of modes(capacity, slots, zero_reason): the ceiling, what modes could take, what they got."""
    return plan.agg(
        F.lit(ceiling).cast("long").alias("ceiling"), F.coalesce(F.sum("capacity"), F.lit(0)).cast("long").alias("capacity"), F.coalesce(F.sum("slots"), F.lit(0)).cast("long").alias("allocated"), F.count(F.lit(1)).alias("modes"),
        F.count(F.when(F.col("capacity") > 0, 1)).alias("modes_able"), F.count(F.when(F.col("slots") > 0, 1)).alias("modes_allocated"), F.countDistinct("zero_reason").alias("zero_reasons"),
    )


def coverage(plan: DataFrame, pool: DataFrame) -> DataFrame:
    """Of each mode the slots allocated, the candidates claimed for them, whether that is all, and why a mode has none."""
    taken = pool.join(plan.select("mode_id", "slots"), "mode_id").where("rank <= slots").groupBy("mode_id").agg(F.count(F.lit(1)).alias("claimed"))
    out = plan.select("mode_id", "slots", "zero_reason").join(taken, "mode_id", "left").withColumn("claimed", F.coalesce("claimed", F.lit(0)))
    uncovered = F.when(F.col("claimed") == 0, F.coalesce("zero_reason", F.lit("unfulfilled")))
    return out.select("mode_id", "slots", "claimed", (F.col("claimed") == F.col("slots")).alias("fulfilled"), uncovered.alias("uncovered_reason"))


def obligation_summary(obligations: DataFrame, keys: list[str] = COORDINATE) -> DataFrame:
    """One row over obligations(keys, role, source_id): coordinates, those of each role, those of more than one obligation, and all
    obligations. role is corridor or global."""
    has = lambda r: F.max((F.col("role") == r).cast("int"))
    each = obligations.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), has("corridor").alias("_c"), has("global").alias("_g"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return each.agg(F.count(F.lit(1)).alias("coordinates"), total("_c").alias("corridor_role"), total("_g").alias("global_role"), total((F.col("_n") > 1).cast("int")).alias("multi_role"), total("_n").alias("obligations"))


def supply_diagnostics(obligations: DataFrame, requested: int, keys: list[str] = COORDINATE) -> DataFrame:
    """One row over what both roles could supply: unique coordinates of each, shared and either, their Jaccard, repeats within a
    role, and the shortfall against the budget that no selection could avoid."""
    has = lambda r: F.sum((F.col("role") == r).cast("long"))
    each = obligations.groupBy(*keys).agg(has("corridor").alias("_c"), has("global").alias("_g"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = lambda c: (c > 0).cast("int")
    out = each.agg(
        total(one(F.col("_c"))).alias("corridor_unique"), total(one(F.col("_g"))).alias("global_unique"), total(one(F.col("_c")) * one(F.col("_g"))).alias("shared"), F.count(F.lit(1)).alias("either"),
        (total("_c") + total("_g") - total(one(F.col("_c"))) - total(one(F.col("_g")))).alias("repeats"),
    )
    short = F.greatest(F.lit(0).cast("long"), F.lit(requested).cast("long") - F.col("either"))
    return out.select("*", F.round(F.col("shared") / F.greatest("either", F.lit(1)), 6).alias("jaccard"), short.alias("shortfall"), F.when(short > 0, "insufficient_eligible_unique_candidates").alias("shortfall_reason"))


def merge_candidates(tables: list[DataFrame], score: str, ties: tuple[str, ...], step: float = 1e-3) -> DataFrame:
    """The candidates of all workers, numbered from 1 in merged_rank by score descending, then ties: the same whatever the workers.
    Numbers come from counts by bands of the score, `step` wide, not from a sort in one task."""
    rows = fold(DataFrame.unionByName, tables).withColumn("_down", -F.col(score).cast("double"))
    return contiguous_ids(rows, ("_down", *ties), F.floor(F.col("_down") / step), "merged_rank").drop("_down")


def valid_length(length: Column, mask: Column, width: int) -> Column:
    """Positions of an example that count: its length, else the sum of its mask, else the width; between 0 and the width."""
    held = F.aggregate(mask, F.lit(0), lambda a, x: a + x.cast("int"))
    return F.greatest(F.lit(0), F.least(F.lit(width), F.coalesce(length.cast("int"), held, F.lit(width))))


def gather(rows: DataFrame, wanted: DataFrame, keys: list[str] = COORDINATE) -> DataFrame:
    """Only those of rows whose keys are wanted, each once however often they are."""
    return rows.join(wanted.select(*keys), keys, "left_semi")


def byte_account(rows: DataFrame, by: list[str], text: str, limit: int) -> DataFrame:
    """Rows and UTF-8 bytes of each group, and whether they keep within a limit of bytes."""
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long").alias("bytes"))
    return out.withColumn("within", F.col("bytes") <= limit)


def quality_per_byte(reference: Column, score: Column, size: Column) -> list[Column]:
    """Absolute and relative delta of two scores, and the delta for each megabyte of an artifact; denominators have a floor."""
    gap, floor = reference.cast("double") - score.cast("double"), F.lit(LEAST_DENOMINATOR)
    return [gap.alias("absolute_delta"), (gap / F.greatest(F.abs(reference.cast("double")), floor)).alias("relative_delta"), (gap / F.greatest(size / 1_000_000.0, floor)).alias("delta_per_mb")]


def entropy_delta(left: Column, right: Column) -> Column:
    """The absolute difference of two entropies; null where either is null, NaN or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    a, b = left.cast("double"), right.cast("double")
    return F.when(finite(a) & finite(b), F.abs(a - b))


def entropy_close(left: Column, right: Column) -> Column:
    """Whether two entropies lie within the quantisation step; false where there is no difference to take."""
    return F.coalesce(entropy_delta(left, right) <= ENTROPY_STEP, F.lit(False))


def timing_summary(runs: DataFrame, by: list[str], value: str) -> DataFrame:
    """Runs, median and spread (largest less least) of each group, and the spread as a share of the median."""
    counts = runs.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(value).alias("_n"))  # so that a hot group is one row a value
    out = counts.groupBy(*by).agg(F.sum("_n").alias("runs"), F.expr("percentile(_v, 0.5, _n)").alias("median"), (F.max("_v") - F.min("_v")).alias("spread"))
    return out.withColumn("normalized_spread", F.when((F.col("median") == 0) & (F.col("spread") == 0), 0.0).when(F.col("median") != 0, F.col("spread") / F.col("median")))


def timing_verdict(baseline: DataFrame, candidate: DataFrame, by: list[str], noise: float = 2.0, regression: float = 0.05) -> DataFrame:
    """Two timing summaries side by side: improved if the medians' gain is beyond noise times the joint spread, regressed if the
    loss is beyond that and beyond a share of the baseline's median. A group of one side alone has no verdict and is left out."""
    side = lambda t, n: t.select(*by, F.col("median").alias(f"{n}_median"), F.col("spread").alias(f"_{n}"))
    both = side(baseline, "baseline").join(side(candidate, "candidate"), by)
    gain, joint = F.col("baseline_median") - F.col("candidate_median"), F.sqrt(F.col("_baseline") * F.col("_baseline") + F.col("_candidate") * F.col("_candidate"))
    return both.select(*by, "baseline_median", "candidate_median", (gain > noise * joint).alias("improved"), (-gain > F.greatest(regression * F.col("baseline_median"), noise * joint)).alias("regressed"))


def inspect_arrays(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(array, dtype, rows, least_width, most_width, nulls, nonfinite) of array columns of numbers."""
    out = []
    for c in columns:
        odd = F.size(F.filter(c, lambda x: F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))))
        kind = rows.schema[c].dataType.elementType.simpleString()
        out.append(rows.agg(F.lit(c).alias("array"), F.lit(kind).alias("dtype"), F.count(F.lit(1)).alias("rows"), F.min(F.array_size(c)).alias("least_width"), F.max(F.array_size(c)).alias("most_width"), F.count(F.when(F.col(c).isNull(), 1)).alias("nulls"), F.coalesce(F.sum(F.when(F.col(c).isNotNull(), odd)), F.lit(0)).cast("long").alias("nonfinite")))
    return fold(DataFrame.unionByName, out)


def check_buckets(rows: DataFrame, tail_items: int, slack: float = 1e-3) -> DataFrame:
    """(check, violations) for rows(bucket_mass, bucket_count, bucket_logp arrays, top_mass, tail_mass): no negative counts or
    masses, no mean in an empty bucket, no positive mean, counts and masses that add up."""
    zipped = F.arrays_zip("bucket_mass", "bucket_count", "bucket_logp")
    some = lambda f: F.exists(zipped, lambda b: f(b["bucket_mass"], b["bucket_count"], b["bucket_logp"]))
    odd = lambda x: F.isnan(x) | (F.abs(x) == float("inf"))
    total = lambda c, t: F.aggregate(c, F.lit(0).cast(t), lambda a, x: a + x)
    mass = total("bucket_mass", "double")
    checks = {
        "count_negative": some(lambda m, n, p: n < 0), "mass_not_finite": some(lambda m, n, p: odd(m)), "mass_negative": some(lambda m, n, p: m < 0), "mean_not_finite": some(lambda m, n, p: odd(p)),
        "empty_bucket_mean": some(lambda m, n, p: (n == 0) & (p != 0)), "mean_positive": some(lambda m, n, p: (n != 0) & (p > 0)), "count_sum": total("bucket_count", "long") != tail_items,
        "tail_mass_differs": F.abs(mass - F.col("tail_mass")) > slack, "mass_not_one": F.abs(F.col("top_mass") + mass - 1) > slack,
    }
    bad = rows.agg(*(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in checks.items()))
    return bad.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in checks))).alias("c")).select("c.*")


def bucket_edges(edges: list) -> tuple[float, ...]:
    """Edges of mass buckets as numbers: from 1 to 0, each below the one before; anything else is an error."""
    out = tuple(float(e) for e in edges)
    if len(out) < 2 or out[0] != 1.0 or out[-1] != 0.0 or not all(a > b for a, b in zip(out, out[1:])):
        raise ValueError("bucket edges must fall from 1 to 0")
    return out

"""Observations of token positions, and their groups: modes (binned statistics) and fingerprints (bucket signatures)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillwork.functions import buckets as B
from quillwork.operators.corpus import chunk_documents, group_tokens

STATS = ("entropy", "top1_margin", "top8_mass", "top32_mass", "stat_tail_mass")
MIN_WIDTH, MAX_MODES, REPRESENTATIVES = 1e-6, 256, 3
#: Rows of the table of statistics by (token, position) that may be broadcast; a larger one is joined by a shuffle.
MOST_PAIRS = 2_000_000


def example_id(doc: Column, chunk: Column) -> Column:
    return F.format_string("doc_%09d_%06d", doc, chunk)


def token_positions(docs: DataFrame, width: int, vocabulary: int, shard_size: int = 1024) -> DataFrame:
    """Every document cut into examples of `width` code points, one row a position; positions beyond an example's text hold
    token 0 and count too."""
    chunks = chunk_documents(docs.select("doc_id", "text"), width)
    rows = chunks.select(
        example_id(F.col("doc_id"), F.col("chunk_index")).alias("example_id"), "doc_id", F.floor(F.col("doc_id") / shard_size).cast("long").alias("shard_id"), F.posexplode(group_tokens(F.col("text"), width, vocabulary)).alias("position", "token")
    )
    return rows.withColumn("length", F.lit(width))


def with_bins(stats: DataFrame) -> DataFrame:
    """Statistics rounded to 9 decimals (so that engines agree at the edges), with mode bins and fingerprint buckets."""
    for c in (*STATS, "confidence"):
        stats = stats.withColumn(c, F.round(c, 9))
    return stats.select(
        "*", B.bin_index(F.col("entropy"), B.ENTROPY_EDGES).alias("entropy_bin"), B.bin_index(F.col("top1_margin"), B.MARGIN_EDGES).alias("margin_bin"),
        B.bin_index(F.col("top32_mass"), B.TOP32_EDGES).alias("top32_bin"), B.entropy_bucket(F.col("entropy")).alias("entropy_bucket"), B.confidence_bucket(F.col("confidence")).alias("confidence_bucket"),
    )


def observe(positions: DataFrame, stats: DataFrame) -> DataFrame:
    """positions with the statistics of their (token, position): one reduction a distinct pair, not a position."""
    small = stats.limit(MOST_PAIRS + 1).count() <= MOST_PAIRS
    joined = positions.join(F.broadcast(stats) if small else stats, ["token", "position"])
    return joined.withColumn("place_bucket", B.place_bucket(F.col("position"), F.col("length")))


def modes(observations: DataFrame, weight: str | None = None) -> DataFrame:
    """One row a triple of bins: mode_id (its 0-based rank), count, share and bounds of each statistic. With a weight, a row stands
    for so many observations: statistics depend on (token, position) alone, so the distinct pairs with their counts will do."""
    keys = ["entropy_bin", "margin_bin", "top32_bin"]
    w = F.lit(1) if weight is None else F.col(weight)
    groups = observations.groupBy(*keys).agg(
        F.sum(w).cast("long").alias("n"), *(f(s).alias(f"{s}_{n}") for s in STATS for n, f in (("min", F.min), ("max", F.max), ("mean", lambda s: F.sum(F.col(s) * w) / F.sum(w))))
    )
    everything = Window.partitionBy()  # over modes: 256 rows at most
    out = groups.select("*", (F.row_number().over(Window.orderBy(*keys)) - 1).cast("int").alias("mode_id"), (F.col("n") / F.sum("n").over(everything)).alias("share"))
    for s in STATS:
        lo, hi, mid = F.col(f"{s}_min"), F.col(f"{s}_max"), (F.col(f"{s}_min") + F.col(f"{s}_max")) / 2
        narrow = hi - lo < MIN_WIDTH
        bound = (lambda x: F.greatest(F.lit(0.0), x)) if s == "entropy" else (lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))
        out = out.withColumns({f"{s}_min": bound(F.when(narrow, mid - MIN_WIDTH / 2).otherwise(lo)), f"{s}_max": bound(F.when(narrow, mid + MIN_WIDTH / 2).otherwise(hi)), f"{s}_mean": bound(F.col(f"{s}_mean"))})
    return out.select("mode_id", *keys, "n", "share", *(f"{s}_{k}" for s in STATS for k in ("min", "max", "mean")))


def representatives(observations: DataFrame, keys: list[str], count: int = REPRESENTATIVES) -> DataFrame:
    """The first observations of each group by (entropy descending, example, position)."""
    w = Window.partitionBy(*keys).orderBy(F.col("entropy").desc(), "example_id", "position")
    return observations.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= count).select(*keys, "rank", "example_id", "position", "entropy")


def fingerprints(observations: DataFrame) -> DataFrame:
    """One row a signature (top token, entropy, confidence and place buckets), numbered by falling count, then signature."""
    keys = ["top_token", "entropy_bucket", "confidence_bucket", "place_bucket"]
    groups = observations.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("entropy").alias("mean_entropy"), F.max("entropy").alias("max_entropy"), F.avg("confidence").alias("mean_confidence"), F.countDistinct("example_id").alias("examples")
    )
    return number_fingerprints(groups, keys)


def number_fingerprints(groups: DataFrame, keys: list[str]) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(F.col("n").desc(), *keys)) - 1  # over signatures: a few for each token
    return groups.select(F.format_string("fp_%06d", rank).alias("fingerprint_id"), *keys, "n", "mean_entropy", "max_entropy", "mean_confidence", "examples")


def assign(observations: DataFrame, mode_table: DataFrame, fingerprint_table: DataFrame | None = None) -> DataFrame:
    """observations with their mode_id and fingerprint_id."""
    keys = ["entropy_bin", "margin_bin", "top32_bin"]
    out = observations.join(F.broadcast(mode_table.select(*keys, "mode_id")), keys)  # 256 modes at most
    if fingerprint_table is not None:
        keys = ["top_token", "entropy_bucket", "confidence_bucket", "place_bucket"]
        out = out.join(fingerprint_table.select(*keys, "fingerprint_id"), keys)
    return out


def example_summary(observations: DataFrame) -> DataFrame:
    """Per example the largest and the mean entropy, and the position of the largest (the first of equals) with its values."""
    first = F.min_by(F.struct("position", "entropy", "confidence", "top_token", "token"), F.struct(-F.col("entropy"), F.col("position"))).alias("s")
    out = observations.groupBy("example_id", "doc_id", "shard_id", "length").agg(F.max("entropy").alias("max_entropy"), F.round(F.avg("entropy"), 9).alias("mean_entropy"), first)
    return out.select("example_id", "doc_id", "shard_id", "length", "max_entropy", "mean_entropy", F.col("s.position").alias("position"), F.col("s.entropy").alias("position_entropy"), F.col("s.confidence").alias("confidence"), F.col("s.top_token").alias("top_token"), F.col("s.token").alias("token"))


def entropy_positions(observations: DataFrame, count: int) -> DataFrame:
    """The `count` positions of largest entropy of each example, ranked; the lesser position first of equals."""
    w = Window.partitionBy("example_id").orderBy(F.col("entropy").desc(), "position")
    return observations.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= count).select("example_id", "rank", "position", "entropy")


def link(selected: DataFrame, assignments: DataFrame) -> DataFrame:
    """selected coordinates with their mode: linked, or missing where no assignment has them."""
    out = selected.join(assignments.select("example_id", "position", "mode_id"), ["example_id", "position"], "left")
    return out.withColumn("assignment_status", F.when(F.col("mode_id").isNull(), "missing").otherwise("linked"))


def link_pairs(selected: DataFrame, pairs: DataFrame) -> DataFrame:
    """link() where selected rows carry the tokens of their example, and the mode follows from (token, position): a position beyond
    them has no assignment. pairs(token, position, mode_id) is one row a distinct pair."""
    at = F.when((F.col("position") >= 0) & (F.col("position") < F.size("tokens")), F.get("tokens", F.col("position")))
    out = selected.withColumn("token", at).drop("tokens").join(F.broadcast(pairs.select("token", "position", "mode_id")), ["token", "position"], "left")  # MOST_PAIRS at most
    return out.withColumn("assignment_status", F.when(F.col("mode_id").isNull(), "missing").otherwise("linked"))

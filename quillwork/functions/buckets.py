"""Bin and bucket ladders as columns, with the fixed edges that decide results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper edges of the mode bins (a value at or above the last belongs to the last bin).
ENTROPY_EDGES = (1.0, 2.5, 4.0, 8.0)
MARGIN_EDGES = (0.05, 0.15, 0.35, 1.0)
TOP32_EDGES = (0.5, 0.75, 0.9, 1.0)
#: Board families in their order of priority.
BOARD_FAMILIES = (
    "global_max_entropy", "low_confidence", "high_tail_mass", "high_effective_top_k", "global_mean_entropy", "position_bucket_entropy", "length_bucket_entropy", "shard_coverage",
)


def bin_index(value: Column, edges: tuple[float, ...]) -> Column:
    """The first bin whose upper edge lies above the value, which counts as 0 where negative; else one past the edges."""
    out = F.lit(len(edges))
    for k in reversed(range(len(edges))):
        out = F.when(F.greatest(value, F.lit(0.0)) < edges[k], F.lit(k)).otherwise(out)
    return out


def entropy_bucket(value: Column) -> Column:
    return F.when(value < 1.0, "low").when(value < 3.0, "mid").when(value < 6.0, "high").otherwise("very_high")


def confidence_bucket(value: Column) -> Column:
    return F.when(value >= 0.75, "high").when(value >= 0.35, "mid").when(value >= 0.10, "low").otherwise("very_low")


def place_bucket(position: Column, length: Column) -> Column:
    """final, early, middle or late: where a position stands in its example."""
    ratio = position.cast("double") / F.greatest(length - 1, F.lit(1))
    return F.when((length <= 1) | (position >= length - 1), "final").when(ratio < 0.33, "early").when(ratio < 0.66, "middle").otherwise("late")


def quarter(position: Column, length: Column) -> Column:
    """Quarter of the example, 0 to 3; 0 for an empty one."""
    return F.when(length <= 0, F.lit(0)).otherwise(F.least(F.lit(3), F.floor(position / length * 4).cast("int")))


def length_class(length: Column) -> Column:
    return F.when(length <= 16, F.lit(0)).when(length <= 64, F.lit(1)).when(length <= 256, F.lit(2)).otherwise(F.lit(3))


def board_priority(board_id: Column) -> Column:
    family = F.substring_index(board_id, ":", 1)
    out = F.lit(len(BOARD_FAMILIES))
    for k in reversed(range(len(BOARD_FAMILIES))):
        out = F.when(family == BOARD_FAMILIES[k], F.lit(k)).otherwise(out)
    return out

"""Long-tail classes of effective k, their boards, caps and summaries, and tags of token pieces."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Class names from short to long, board names, and tags in their order of precedence.
CLASSES = ("normal", "long_tail", "very_long_tail", "suspicious_flat", "full_vocab_or_near_full_vocab")
PRIMARY, UNCERTAIN, PERVERSE = "primary", "long_tail_uncertainty", "perverse_tail_diagnostic"
TAGS = ("proper_name_tail", "numeric_tail", "url_or_markup_tail", "whitespace_or_boundary_tail", "code_or_symbol_tail")
OTHER_TAG = "unknown_open_class_tail"
MARKUP, NUMERIC, SYMBOLS, NAMES = r"\A(http|www\.|<|#)|://|=|/", r"\A[\p{Nd}.,:%+\-/]*\z", r"[{}\[\]()<>_=;`\\|~]", r"\A\p{Lu}\p{L}*\z|\A(Mc|Mac|O'|van|de)"


@dataclass(frozen=True)
class TailPolicy:
    long: int = 8192
    very_long: int = 32768
    perverse: int = 65536


def classify(k: Column, vocabulary: int, policy: TailPolicy = TailPolicy()) -> Column:
    return F.when(k >= vocabulary, CLASSES[4]).when(k >= policy.perverse, CLASSES[3]).when(k >= policy.very_long, CLASSES[2]).when(k >= policy.long, CLASSES[1]).otherwise(CLASSES[0])


def board_of(tail_class: Column) -> Column:
    return F.when(tail_class == CLASSES[0], PRIMARY).when(tail_class.isin(*CLASSES[1:3]), UNCERTAIN).otherwise(PERVERSE)


def cap_boards(rows: DataFrame, caps: dict[str, int], order: tuple[str, ...], board: str = "board") -> DataFrame:
    """The first rows of each board in order, up to its cap; a board without a cap keeps all."""
    cap = F.lit(None).cast("int")
    for name, most in caps.items():
        cap = F.when(F.col(board) == name, most).otherwise(cap)
    capped = rows.where(cap.isNotNull()).withColumn("_k", F.row_number().over(Window.partitionBy(board).orderBy(*order))).where(F.col("_k") <= cap).drop("_k")
    return capped.unionByName(rows.where(cap.isNull()))


def summarize(rows: DataFrame, k: str, tail_class: str, saturated: Column, vocabulary: int) -> list[Column]:
    """Aggregates: rows in all, by class and saturated, and the effective k."""
    return [
        F.count(F.lit(1)).alias("n"), *(F.sum((F.col(tail_class) == c).cast("long")).alias(f"n_{c}") for c in CLASSES), F.sum(saturated.cast("long")).alias("n_saturated"), F.max(k).cast("long").alias("max_k"),
        F.round(F.avg(k), 6).alias("mean_k"), F.round(F.max(k) / vocabulary, 6).alias("max_fraction"),
    ]


def piece_tag(piece: Column) -> Column:
    """The tag of one stripped token piece."""
    return F.when(piece.rlike(MARKUP), TAGS[2]).when(piece.rlike(NUMERIC), TAGS[1]).when(piece == "", TAGS[3]).when(piece.rlike(SYMBOLS), TAGS[4]).when(piece.rlike(NAMES), TAGS[0]).otherwise(OTHER_TAG)


def majority_tag(pieces: DataFrame, keys: list[str], piece: str = "piece") -> DataFrame:
    """The first tag, in order of precedence, that half of a group's pieces or more carry."""
    tagged = pieces.where(F.col(piece) != "").withColumn("_t", piece_tag(F.col(piece)))
    counts = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("pieces"), *(F.sum((F.col("_t") == t).cast("long")).alias(t) for t in TAGS))
    out = F.lit(OTHER_TAG)
    for t in reversed(TAGS):
        out = F.when(F.col(t) * 2 >= F.col("pieces"), t).otherwise(out)
    return counts.select(*keys, "pieces", out.alias("tag"))

"""Corridor selection: candidate scores (C1), pools (C2), budget (C3), claims with backfill (C4) and records (C5)."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import ROUND_FLOOR, Decimal
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CORRIDOR, GLOBAL = "fingerprint_corridor_representative", "global_board"
#: Candidates of a mode's pool.
POOL_CAP = 4
#: Assignment states that count as no assignment.
UNASSIGNED = ("missing", "unassigned", "failed", "invalid")


@dataclass(frozen=True)
class Archetype:
    """Thresholds and weights of a candidate's score; the weights are normalised."""

    least_membership: float = 0.5
    most_distance: float = 0.5
    least_support: int = 1
    membership: float = 0.45
    centrality: float = 0.40
    difficulty: float = 0.15
    quality: float = 0.0

    def share(self, name: str) -> float:
        return getattr(self, name) / (self.membership + self.centrality + self.difficulty + self.quality)


@dataclass(frozen=True)
class Budget:
    """Total slots, the corridors' share of them (exact decimal), and slots a mode."""

    total: int = 32
    fraction: str = "0.50"
    mode_cap: int = 10
    ceiling: int | None = None

    @property
    def corridor_ceiling(self) -> int:
        slots = int((Decimal(self.total) * Decimal(self.fraction)).to_integral_value(ROUND_FLOOR))
        return slots if self.ceiling is None else min(slots, self.ceiling)


def unit(x: Column) -> Column:
    """Clamped to [0, 1]; null and NaN are 0."""
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.nanvl(x.cast("double"), F.lit(0.0)))), F.lit(0.0))


def features(assigned: DataFrame, mode_table: DataFrame, vocabulary: int) -> DataFrame:
    """Candidate features of assigned observations: how near the mean entropy of their mode, and how hard."""
    bounds = mode_table.select("mode_id", F.col("n").alias("mode_support"), *(F.col(f"entropy_{k}").alias(f"_{k}") for k in ("min", "max", "mean")))
    wide = F.greatest(F.abs(F.col("_mean") - F.col("_min")), F.abs(F.col("_max") - F.col("_mean")), F.lit(1e-6))
    membership = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - F.abs(F.col("entropy") - F.col("_mean")) / wide))
    out = assigned.join(F.broadcast(bounds), "mode_id")  # 256 modes at most
    out = out.withColumn("membership_strength", F.round(membership, 9)).withColumn("core_distance", F.round(1.0 - F.col("membership_strength"), 9))
    return out.withColumn("difficulty_score", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("entropy") / math.log(max(vocabulary, 2)))), 9)).drop("_min", "_max", "_mean")


def score_candidates(rows: DataFrame, policy: Archetype = Archetype()) -> DataFrame:
    """rows with the component scores, the ordered reasons that bar a candidate, and the utility of one that none bars.

    rows: position, mode_id, membership_strength, core_distance, mode_support, difficulty_score, and optionally
    assignment_status, position_valid and quality_score.
    """
    have = rows.columns
    status = F.col("assignment_status") if "assignment_status" in have else F.lit("linked")
    valid = F.col("position_valid") if "position_valid" in have else F.lit(True)
    quality = F.col("quality_score").cast("double") if "quality_score" in have else F.lit(None).cast("double")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    m, d, h = (F.col(c).cast("double") for c in ("membership_strength", "core_distance", "difficulty_score"))
    odd = ~(finite(m) & finite(d) & finite(h) & F.col("mode_support").isNotNull()) | (quality.isNotNull() & ~finite(quality))
    beyond = lambda x: F.coalesce(finite(x) & ~x.between(0.0, 1.0), F.lit(False))
    reasons = F.array(
        F.when(~valid | (F.col("position") < 0), "invalid_position"), F.when(F.col("mode_id").isNull() | (F.col("mode_id") < 0) | status.isin(*UNASSIGNED), "unassigned_corridor").when(status != "linked", "invalid_assignment_status"),
        F.when(odd, "nonfinite_feature"), F.when(beyond(m) | beyond(d) | beyond(h) | beyond(quality), "feature_out_of_range"), F.when(finite(m) & (m < policy.least_membership), "membership_below_minimum"),
        F.when(finite(d) & (d > policy.most_distance), "outside_corridor_core"), F.when(F.col("mode_support") < policy.least_support, "mode_support_below_minimum"),
    )
    near = unit(1.0 - d / policy.most_distance) if policy.most_distance else F.when(d == 0, 1.0).otherwise(0.0)
    near = F.when(finite(d) & (d >= 0), near).otherwise(0.0)
    out = rows.withColumn("reasons", F.array_compact(reasons)).withColumn("eligible", F.size("reasons") == 0)
    out = out.withColumn("membership_score", unit(m)).withColumn("centrality_score", near).withColumn("useful_difficulty", unit(h)).withColumn("quality", unit(quality))
    utility = sum(policy.share(n) * F.col(c) for n, c in (("membership", "membership_score"), ("centrality", "centrality_score"), ("difficulty", "useful_difficulty"), ("quality", "quality")))
    return out.withColumn("utility", F.when(F.col("eligible"), F.round(unit(utility), 9)))


def mode_pools(scored: DataFrame, cap: int = POOL_CAP) -> DataFrame:
    """The best `cap` eligible candidates of each mode, ranked."""
    down = [F.col(c).desc() for c in ("utility", "membership_score", "centrality_score", "useful_difficulty")]
    w = Window.partitionBy("mode_id").orderBy(*down, "example_id", "position")
    out = scored.where("eligible and mode_id is not null").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap)
    return out.select("mode_id", "rank", "example_id", "position", "utility", "membership_score", "centrality_score", "useful_difficulty", "quality", "mode_support")


def leading(scored: DataFrame, cap: int = POOL_CAP) -> DataFrame:
    """Of scored rows that each stand for several candidates, those whose candidates can reach a mode's pool: the `cap` best
    levels of score. The candidates themselves are then joined to these alone."""
    w = Window.partitionBy("mode_id").orderBy(*(F.col(c).desc() for c in ("utility", "membership_score", "centrality_score", "useful_difficulty")))
    return scored.where("eligible and mode_id is not null").withColumn("_level", F.dense_rank().over(w)).where(F.col("_level") <= cap).drop("_level")


def mode_counts(scored: DataFrame, weight: str | None = None) -> DataFrame:
    """Candidates seen, eligible and rejected of each mode, with its support; with a weight, a row stands for so many."""
    n = F.lit(1) if weight is None else F.col(weight)
    return scored.groupBy("mode_id").agg(F.sum(n).cast("long").alias("seen"), F.sum(F.when(F.col("eligible"), n).otherwise(0)).cast("long").alias("eligible"), F.sum(F.when(F.col("eligible"), 0).otherwise(n)).cast("long").alias("rejected"), F.max("mode_support").alias("mode_support"))


def rejections(scored: DataFrame, weight: str | None = None) -> DataFrame:
    """How often each reason barred a candidate of each mode."""
    n = F.lit(1) if weight is None else F.col(weight)
    return scored.select("mode_id", n.alias("_n"), F.explode("reasons").alias("reason")).groupBy("mode_id", "reason").agg(F.sum("_n").cast("long").alias("n"))


def crossing(pool: DataFrame) -> DataFrame:
    """Coordinates that more than one mode holds: none may, before claims."""
    return pool.groupBy("example_id", "position").agg(F.countDistinct("mode_id").alias("modes")).where("modes > 1")


def allocate(counts: DataFrame, pool: DataFrame, policy: Budget = Budget()) -> DataFrame:
    """Slots of each mode: one each in rounds, modes ascending, until the budget ends; if there are more modes than slots, the
    modes with the best first candidate get one each. All windows are over modes: 256 rows at most."""
    first = F.min_by(F.struct("utility", "membership_score", "centrality_score"), "rank").alias("top")
    held = pool.groupBy("mode_id").agg(F.count(F.lit(1)).alias("retained"), first)
    rows = counts.join(held, "mode_id", "left").select("mode_id", "seen", "eligible", "rejected", "mode_support", F.coalesce("retained", F.lit(0)).alias("retained"), *(F.coalesce(f"top.{c}", F.lit(0.0)).alias(c) for c in ("utility", "membership_score", "centrality_score")))
    rows = rows.withColumn("capacity", F.least(F.lit(policy.mode_cap), "retained", "eligible").cast("int"))
    everything = Window.partitionBy()
    rows = rows.withColumn("budget", F.least(F.lit(policy.corridor_ceiling), F.sum("capacity").over(everything))).withColumn("able", F.sum((F.col("capacity") > 0).cast("int")).over(everything))
    slots = rows.where("capacity > 0").select("mode_id", "budget", "able", "utility", "membership_score", "centrality_score", "mode_support", F.explode(F.sequence(F.lit(1), F.col("capacity"))).alias("slot"))
    few = slots.where("slot = 1").withColumn("place", F.row_number().over(Window.orderBy(F.col("utility").desc(), F.col("membership_score").desc(), F.col("centrality_score").desc(), F.col("mode_support").desc(), "mode_id"))).where("budget < able")
    many = slots.withColumn("place", F.row_number().over(Window.orderBy("slot", "mode_id"))).where("budget >= able")
    given = few.unionByName(many).where("place <= budget").groupBy("mode_id").agg(F.count(F.lit(1)).alias("slots"))
    out = rows.join(given, "mode_id", "left").withColumn("slots", F.coalesce("slots", F.lit(0)))
    reason = F.when(F.col("slots") > 0, F.lit(None).cast("string")).when((F.col("eligible") == 0) & (F.col("seen") == 0), "empty_candidate_pool").when(F.col("eligible") == 0, "no_eligible_candidates").when(F.col("retained") == 0, "empty_candidate_pool")
    reason = reason.when(F.col("capacity") == 0, "mode_capacity_zero").otherwise("corridor_budget_exhausted")
    return out.select("mode_id", "capacity", "slots", "retained", "eligible", "seen", "rejected", "mode_support", reason.alias("zero_reason"))


@dataclass(frozen=True)
class Supply:
    """A global board's ranked candidates: (example_id, position, rank, score, eligible)."""

    board_id: str
    priority: int
    requested: int
    candidates: tuple[tuple[str, int, int, float, bool], ...]


def board_walk(board: Supply, owner: dict[tuple[str, int], str], target: int) -> pd.DataFrame:
    """The candidates that a board looks at until it has `target` claims, as rows (at, rank, score, status, place, filled).

    status: ineligible, corridor_collision or global_collision (the coordinate has an owner, or stood higher on the board), or
    free. place counts the free rows, and filled the replacements among them: a claim is one if an earlier skip still waits.
    """
    rows = pd.DataFrame(board.candidates, columns=["example_id", "position", "rank", "score", "eligible"])
    rows["at"] = pd.Series(list(zip(rows["example_id"], rows["position"], strict=True)), dtype=object)
    able = rows["eligible"].to_numpy(bool)
    held = np.array([owner.get(at, "") for at in rows["at"]], dtype=object)
    held[rows.index[able][rows["at"][able].duplicated() & (held[able] == "")]] = "global"
    rows["status"] = np.select([~able, held != ""], ["ineligible", held + "_collision"], "free")
    free = (rows["status"] == "free").to_numpy()
    rows["place"] = free.cumsum()
    rows = rows[rows["place"] - free < target]
    free = free[: len(rows)]
    # A queue: skips come, claims take one each; those that found it empty are the highest excess of claims over skips so far.
    idle = np.maximum.accumulate(np.maximum(0, free.cumsum() - (~free).cumsum())) if len(rows) else np.zeros(0, int)
    return rows.assign(filled=free.cumsum() - idle)


def claim(corridor: list[tuple[int, int, str, int, float]], boards: Iterable[Supply], total: int, ordered: bool = False) -> tuple[list[dict], list[dict], list[dict]]:
    """Corridor candidates (mode, rank, example, position, score) are claimed first; boards fill what is left of the total.

    Returns the claimed coordinates with their obligations, the lineage of skipped candidates, and a summary a board. A board
    passes over ineligible candidates and coordinates already claimed (which gain an obligation); its n-th replacement pairs
    with its n-th skip. A coordinate of two modes is an error. Boards that come ordered, from a stream that need not fit in
    memory, are read until the total is reached and no further.
    """
    first = pd.DataFrame(sorted(corridor), columns=["mode", "rank", "example_id", "position", "score"])
    if first.duplicated(["example_id", "position"]).any():
        raise ValueError("a coordinate is a candidate of more than one mode")
    claims = [
        {"example_id": r.example_id, "position": r.position, "primary": CORRIDOR, "source": str(r.mode), "backfilled": False, "obligations": [{"role": CORRIDOR, "source_id": str(r.mode), "rank": r.rank, "score": r.score, "priority": -1}]}
        for r in first.itertuples()
    ]
    owner = {(c["example_id"], c["position"]): "corridor" for c in claims}
    duties = {at: c["obligations"] for at, c in zip(owner, claims, strict=True)}
    lineage, summaries = [], []
    for board in boards if ordered else sorted(boards, key=lambda b: (b.priority, b.board_id)):
        if ordered and len(claims) >= total:
            break
        target = min(board.requested, max(0, total - len(claims)))
        rows = board_walk(board, owner, target)
        taken, skipped = rows[rows["status"] == "free"], rows[rows["status"] != "free"]
        replaces = taken["filled"].diff().fillna(taken["filled"]) > 0
        for r, back in zip(taken.itertuples(), replaces, strict=True):
            owner[r.at], duties[r.at] = "global", []
            claims.append({"example_id": r.at[0], "position": r.at[1], "primary": GLOBAL, "source": board.board_id, "backfilled": bool(back), "obligations": duties[r.at]})
        for r in rows[rows["status"] != "ineligible"].itertuples():
            duties[r.at].append({"role": GLOBAL, "source_id": board.board_id, "rank": r.rank, "score": r.score, "priority": board.priority})
        left = skipped.assign(n=range(1, len(skipped) + 1))[["n", "rank", "at", "status"]]
        right = taken[replaces].assign(n=range(1, int(replaces.sum()) + 1))[["n", "rank", "at"]]
        for r in left.merge(right, on="n", how="left", suffixes=("", "_by")).itertuples():
            met = isinstance(r.at_by, tuple)
            lineage.append({"board_id": board.board_id, "skipped_rank": r.rank, "skipped": r.at, "reason": r.status, "replacement_rank": int(r.rank_by) if met else None, "replacement": r.at_by if met else None})
        barred = int((rows["status"] == "ineligible").sum())
        summaries.append({"board_id": board.board_id, "target": target, "fulfilled": len(taken), "collisions": len(skipped) - barred, "ineligible": barred, "backfills": int(replaces.sum()), "exhausted": len(taken) < target})
    return [c | {"claim_order": k} for k, c in enumerate(claims)], lineage, summaries


def payload_key(example: str, position: int) -> str:
    return "coordinate_v1:" + hashlib.sha256(json.dumps([example, position], separators=(",", ":")).encode()).hexdigest()


def payload_key_column(example: Column, position: Column) -> Column:
    """payload_key for ids of plain ASCII without quotes or backslashes."""
    return F.concat(F.lit("coordinate_v1:"), F.sha2(F.concat(F.lit('["'), example, F.lit('",'), position.cast("string"), F.lit("]")).cast("binary"), 256))


def supplies(boards: DataFrame, capacity: int) -> Iterator[Supply]:
    """The boards' pools in the order of their ids, read from the sorted table part by part: a part at a time is in memory."""
    for board, rows in groupby(boards.orderBy("board_id", "rank").toLocalIterator(), key=lambda r: r["board_id"]):
        yield Supply(board, 0, capacity, tuple((r["example_id"], r["position"], r["rank"], r["score"], True) for r in rows))


def claim_selected(pool: DataFrame, plan: DataFrame, boards: DataFrame, capacity: int, total: int) -> tuple[list[dict], list[dict], list[dict]]:
    """claim() over the first slots of each mode's pool (256 modes at most) and any number of boards, which are read until the
    total is reached; unreached() gives those that were not. Boards stand in the order of their ids, as published supplies carry
    no priority. A coordinate of two modes stops it before any claim."""
    if crossing(pool).limit(1).count():
        raise ValueError("a coordinate is in the pools of more than one mode")
    corridor = pool.join(plan.select("mode_id", "slots"), "mode_id").where("rank <= slots").select("mode_id", "rank", "example_id", "position", "utility").collect()
    return claim([tuple(r) for r in corridor], supplies(boards, capacity), total, ordered=True)


def unreached(boards: DataFrame, summaries: list[dict]) -> DataFrame:
    """(board_id) of the boards beyond the last that claims came to: their target is 0."""
    left = boards.where(F.col("board_id") > summaries[-1]["board_id"]) if summaries else boards
    return left.select("board_id").distinct()


RECORD = "selection_index int, example_id string, position int, primary_claim string, roles string, modes string, boards string, obligations int, multi_role boolean, payload_key string"


def records(claims: list[dict]) -> list[tuple]:
    """One durable row a claimed coordinate: its roles and sources in canonical order, and its payload key."""
    out = []
    for c in claims:
        duties = sorted(c["obligations"], key=lambda o: (o["role"] != CORRIDOR, o["priority"], o["source_id"], o["rank"]))
        roles = [r for r in (CORRIDOR, GLOBAL) if any(o["role"] == r for o in duties)]
        modes = sorted({int(o["source_id"]) for o in duties if o["role"] == CORRIDOR})
        boards = list(dict.fromkeys(o["source_id"] for o in duties if o["role"] == GLOBAL))
        out.append((c["claim_order"], c["example_id"], c["position"], c["primary"], ",".join(roles), ",".join(map(str, modes)), ",".join(boards), len(duties), len(duties) > 1, payload_key(c["example_id"], c["position"])))
    return out

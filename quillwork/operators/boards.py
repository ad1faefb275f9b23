"""Leaderboards of candidates: pools, one board a coordinate with backfill, and the example budget."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillwork.functions import buckets as B
from quillwork.sources.folders import discard, stash

POOL_FACTOR = 4
#: Candidates after which a task cuts what it holds, and those it may hold after a cut.
CUT_AT, MOST_HELD = 1 << 16, 1 << 19
COORDINATE = ("example_id", "position")


def board_scores(candidates: DataFrame) -> DataFrame:
    """One row a candidate and board that it has a score for. candidates: example_id, position, length, shard_id and the score
    columns max_entropy, mean_entropy, confidence, position_entropy, and, where captured, tail_mass and effective_top_k."""
    at = lambda c: F.col(c).cast("double") if c in candidates.columns else F.lit(None).cast("double")
    pair = lambda b, s: F.struct(b.alias("board_id"), s.alias("score"))
    named = lambda family, key: F.concat(F.lit(f"{family}:"), key.cast("string"))
    boards = F.array(
        pair(F.lit("global_max_entropy"), at("max_entropy")), pair(F.lit("global_mean_entropy"), at("mean_entropy")), pair(F.lit("low_confidence"), F.lit(1.0) - at("confidence")), pair(F.lit("high_tail_mass"), at("tail_mass")),
        pair(F.lit("high_effective_top_k"), at("effective_top_k")), pair(named("position_bucket_entropy", B.quarter(F.col("position"), F.col("length"))), at("position_entropy")),
        pair(named("length_bucket_entropy", B.length_class(F.col("length"))), at("position_entropy")), pair(named("shard_coverage", F.col("shard_id")), at("position_entropy")),
    )
    return candidates.select("example_id", "position", F.explode(F.filter(boards, lambda b: b["score"].isNotNull())).alias("b")).select("b.board_id", F.round("b.score", 9).alias("score"), "example_id", "position")


def contenders(candidates: DataFrame, capacity: int) -> DataFrame:
    """The candidates of board_scores that can reach a pool, and each board's first example, by running cuts in each task: all others
    have 4 * capacity better ones on each of their boards. Pools and first examples are those of all candidates; what is left to
    sort is small. Boards too many to keep in memory are passed on uncut, in parts."""
    most = POOL_FACTOR * capacity
    keys = {"_quarter": B.quarter(F.col("position"), F.col("length")), "_class": B.length_class(F.col("length"))}
    at = {c: F.round(F.col(c).cast("double"), 9) for c in ("max_entropy", "mean_entropy", "tail_mass", "effective_top_k", "position_entropy") if c in candidates.columns}
    at["confidence"] = F.round(F.lit(1.0) - F.col("confidence").cast("double"), 9)
    lists = [(None, c) for c in at if c != "position_entropy"] + [(k, "position_entropy") for k in ("_quarter", "_class", "shard_id")]
    names = candidates.columns
    helpers = {**{k: v.cast("long") for k, v in keys.items()}, "_shard": F.col("shard_id").cast("long"), **{f"_s_{c}": v for c, v in at.items()}}
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.schema.fields)

    def cut(rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(rows, [("example_id", "ascending"), ("position", "ascending")]).to_numpy()
        tie = np.empty(len(order), np.int64)
        tie[order] = np.arange(len(order))
        keep = np.zeros(len(order), bool)
        for key, score in lists:
            column = rows[f"_s_{score}"]
            own = np.flatnonzero(~column.is_null().to_numpy())
            s = column.to_numpy()[own].astype(float)
            k = np.zeros(len(own), np.int64) if key is None else np.unique(pc.fill_null(rows["_shard" if key == "shard_id" else key], -(1 << 62)).to_numpy()[own], return_inverse=True)[1]
            for by, n in ((np.lexsort((tie[own], -s, ~np.isnan(s), k)), most), (np.lexsort((tie[own], k)), 1)):
                start = np.flatnonzero(np.r_[True, np.diff(k[by]) != 0]) if len(by) else np.zeros(0, int)
                nth = np.arange(len(by)) - np.repeat(start, np.diff(np.r_[start, len(by)]))
                keep[own[by[nth < n]]] = True
        return rows.filter(pa.array(keep))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new = [], 0
        for batch in batches:
            held, new = [*held, batch], new + batch.num_rows
            if new >= CUT_AT:
                rows = cut(pa.Table.from_batches(held))
                if len(rows) > MOST_HELD:
                    yield from rows.select(names).to_batches()
                    held, new = [], 0
                else:
                    held, new = rows.combine_chunks().to_batches(), min(0, CUT_AT // 2 - len(rows))
        if held:
            yield from cut(pa.Table.from_batches(held)).select(names).to_batches()

    return candidates.select("*", *(v.alias(k) for k, v in helpers.items())).mapInArrow(work, kinds)


def pools(scores: DataFrame, capacity: int) -> DataFrame:
    """The first 4 * capacity of each board by (score descending, example, position), ranked from 1."""
    w = Window.partitionBy("board_id").orderBy(F.col("score").desc(), "example_id", "position")
    out = scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= POOL_FACTOR * capacity)
    return out.select("board_id", B.board_priority(F.col("board_id")).alias("priority"), "rank", "score", "example_id", "position")


def shared_candidates(pool: DataFrame) -> DataFrame:
    """Coordinates on more than one board's pool, with the number of boards."""
    return pool.groupBy("example_id", "position").agg(F.countDistinct("board_id").alias("boards")).where("boards > 1")


def assign_winners(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """winners() over pools that fit in one frame. Each coordinate on one board: the rows of a pool (board_id, priority, seen, rank, score, example_id, position) that win.

    Of the first `capacity` rows of all boards each coordinate keeps its strongest: best rank, then score, board priority and
    board order. The places this frees are filled board by board with the best rows whose coordinates no board holds; each
    such row takes its coordinate off the lists of the boards that follow. Nothing can move after that, as no coordinate is
    held twice. Boards of one family stand in the order in which their first candidate was seen.
    """
    rows = rows.sort_values(["priority", "seen", "board_id", "rank"], ignore_index=True)
    rows["place"] = rows.groupby(["priority", "seen", "board_id"], sort=False).ngroup()
    rows["at"] = rows.groupby(["example_id", "position"], sort=False).ngroup()
    rows["boards"] = rows.groupby("at")["board_id"].transform("size")
    opening = rows[rows.groupby("place").cumcount() < capacity]
    strongest = opening.assign(weakness=-opening["score"]).sort_values(["rank", "weakness", "priority", "place"]).drop_duplicates("at").index
    won = rows.index.isin(strongest)
    rows["backfills"] = 0
    free = capacity - pd.Series(won).groupby(rows["place"]).sum()
    held = np.zeros(rows["at"].max() + 1 if len(rows) else 0, bool)
    held[rows["at"][won]] = True
    for place in free.index[free > 0]:
        own = rows.index[rows["place"] == place]
        more = own[~held[rows["at"][own]]][: free[place]]
        won[more], held[rows["at"][more]] = True, True
        rows.loc[own, "backfills"] = len(more)
    return rows.loc[won, ["board_id", "priority", "example_id", "position", "rank", "score", "boards", "backfills"]].reset_index(drop=True)


def backfill(waiting: DataFrame) -> DataFrame:
    """The rows of waiting(board_id, place, rank, free, example_id, position, ...) that take the boards' free places.

    Deferred acceptance: each board asks for the best `free` rows that have not been refused, a coordinate that several ask for
    stays with the first of them by place, and refuses all later ones, also those that have not asked yet. All coordinates favour boards in the same
    order, so this ends where filling board after board would. A round is two windows over groups of at most 4 * capacity rows
    of a board and of one row a board for a coordinate; only coordinates that several boards wait for cause another round.
    """
    names = waiting.columns
    by_board, by_coordinate = Window.partitionBy("board_id").orderBy("rank"), Window.partitionBy(*COORDINATE)
    turn = 0
    while True:
        asked = F.when(F.row_number().over(by_board) <= F.col("free"), F.struct("place", "rank"))
        settled = waiting.withColumn("_asks", asked).withColumn("_first", F.min("_asks").over(by_coordinate))
        refused = F.coalesce(F.struct("place", "rank") > F.col("_first"), F.lit(False))
        table = stash(settled.select(*names, F.col("_asks").isNotNull().alias("_asked"), refused.alias("_refused")), "backfill")
        if turn:
            discard(before)
        if table.where("_asked and _refused").isEmpty():
            return table.where("_asked").select(*names)
        before, waiting, turn = table, table.where("not _refused").select(*names), turn + 1


def winners(pool: DataFrame, capacity: int) -> DataFrame:
    """Each coordinate on one board: the rows of pool(board_id, priority, seen, rank, score, example_id, position) that win, with
    the number of pool rows of their coordinate as boards.

    Of the first `capacity` rows of all boards each coordinate keeps its strongest: best rank, then score, board priority and
    board order. Places this frees go, board after board, to the best rows whose coordinates no board holds. Nothing is
    gathered anywhere, so there may be any number of boards. The pool is read several times: pass a table.
    """
    at = Window.partitionBy(*COORDINATE)
    place, strength = F.struct("priority", "seen", "board_id"), F.struct("rank", (-F.col("score")).alias("weakness"), "priority", "seen", "board_id")
    rows = pool.withColumn("boards", F.count(F.lit(1)).over(at).cast("int")).withColumn("_best", F.min(F.when(F.col("rank") <= capacity, strength)).over(at))
    names = [*pool.columns, "boards"]
    won = rows.where((F.col("rank") <= capacity) & (F.col("_best") == strength)).select(*names)
    full = won.groupBy("board_id").agg(F.count(F.lit(1)).alias("_held"))
    free = (F.lit(capacity) - F.coalesce("_held", F.lit(0))).alias("free")
    waiting = rows.where("_best is null").select(*names, place.alias("place")).join(full, "board_id", "left").select(*names, "place", free).where("free > 0")
    return won.unionByName(backfill(waiting).select(*names))


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """rows numbered from 1 in a total order: sorted by range, then each part starts where those before it end. The only window
    in one task is over one row a part."""
    parts = stash(rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered").withColumn("_part", F.shiftright("_id", 33))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("_part", before.alias("_before")))  # one row a partition of the sort
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return parts.join(starts, "_part").withColumn(name, F.col("_before") + within + 1).drop("_id", "_part", "_before")


def select_exemplars(scores: DataFrame, capacity: int, budget: int | None = None, fraction: float | None = None) -> DataFrame:
    """(selection_rank, example_id, position, board_id, rank, score, boards): winners of the boards, trimmed to the budget.

    Examples are ordered by their best (rank, priority, -score, -boards, example, position); the first
    min(n, budget, max(1, ceil(n * fraction))) stay with all their positions. Without scores there are no rows.
    """
    seen = scores.groupBy("board_id").agg(F.min("example_id").alias("seen"))
    won = stash(winners(stash(pools(scores, capacity).join(seen, "board_id"), "pools"), capacity), "winners")
    key = F.struct("rank", "priority", (-F.col("score")).alias("weakness"), (-F.col("boards")).alias("scarcity"), "example_id", "position")
    best = won.groupBy("example_id").agg(F.min(key).alias("key"))
    ranks = numbered(best.select("example_id", "key"), ["key"], "selection_rank")
    n = ranks.count()
    limit = min(n, budget if budget is not None else n, max(1, ceil(n * fraction)) if fraction is not None else n)
    kept = ranks.where(F.col("selection_rank") <= limit).select("example_id", F.col("selection_rank").cast("int").alias("selection_rank"))
    return won.join(kept, "example_id").select("selection_rank", "example_id", F.col("position").cast("int").alias("position"), "board_id", F.col("rank").cast("int").alias("rank"), F.col("score").cast("double").alias("score"), "boards")

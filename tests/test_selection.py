from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillwork.functions import buckets as B
from quillwork.operators import boards, corridor, longtail, reduce, selection


def candidate(spark, **changes):
    row = {"example_id": "e", "position": 1, "mode_id": 0, "membership_strength": 0.9, "core_distance": 0.1, "mode_support": 10, "difficulty_score": 0.5, "assignment_status": "linked", "position_valid": True, "quality_score": None} | changes
    schema = "example_id string, position int, mode_id int, membership_strength double, core_distance double, mode_support int, difficulty_score double, assignment_status string, position_valid boolean, quality_score double"
    return selection.score_candidates(spark.createDataFrame([tuple(row.values())], schema)).first()


def test_published_candidate_score(spark):
    r = candidate(spark, membership_strength=0.95807255754747, core_distance=1 - 0.95807255754747, difficulty_score=0.9317349673592276)
    assert r["centrality_score"] == pytest.approx(0.91614511509494, abs=1e-6) and r["utility"] == pytest.approx(0.9373509420382218, abs=1e-6)


@pytest.mark.parametrize(
    ("changes", "reasons"),
    [
        ({}, []), ({"position": -1}, ["invalid_position"]), ({"mode_id": None}, ["unassigned_corridor"]), ({"assignment_status": "odd"}, ["invalid_assignment_status"]), ({"membership_strength": float("nan")}, ["nonfinite_feature"]),
        ({"membership_strength": 0.4, "core_distance": 0.6}, ["membership_below_minimum", "outside_corridor_core"]), ({"mode_support": 0}, ["mode_support_below_minimum"]), ({"difficulty_score": 1.5}, ["feature_out_of_range"]), ({"quality_score": -1.0}, ["feature_out_of_range"]),
    ],
)
def test_reasons_in_order(spark, changes, reasons):
    r = candidate(spark, **changes)
    assert r["reasons"] == reasons and r["eligible"] == (not reasons) and (r["utility"] is None) == bool(reasons)


def round_robin(capacities, budget):
    out = dict.fromkeys(sorted(capacities), 0)
    while budget and any(out[m] < capacities[m] for m in out):
        for m in out:
            if budget and out[m] < capacities[m]:
                out[m] += 1
                budget -= 1
    return out


def test_allocation_rounds_and_scarcity(spark):
    rng = random.Random(6)
    for total in (8, 20, 200):
        caps = {m: rng.randint(0, 4) for m in range(9)}
        counts = spark.createDataFrame([(m, 10, c, 10 - c, 5) for m, c in caps.items()], "mode_id int, seen long, eligible long, rejected long, mode_support long")
        pool = spark.createDataFrame([(m, k + 1, 1.0 - m / 100, 0.5, 0.5) for m, c in caps.items() for k in range(c)], "mode_id int, rank int, utility double, membership_score double, centrality_score double")
        got = {r["mode_id"]: r["slots"] for r in selection.allocate(counts, pool, selection.Budget(total)).collect()}
        budget = min(total // 2, sum(caps.values()))
        able = [m for m in caps if caps[m]]
        want = round_robin(caps, budget) if budget >= len(able) else {m: int(m in able[:budget]) for m in caps}
        assert got == want


def test_ceiling_is_an_exact_decimal():
    assert selection.Budget(10, "0.3").corridor_ceiling == 3 and selection.Budget(29, "0.7").corridor_ceiling == 20 and selection.Budget(100, "0.5", ceiling=7).corridor_ceiling == 7


def test_claims_collide_backfill_and_pair_in_order():
    corridor_rows = [(0, 1, "a", 0, 0.9)]
    one = selection.Supply("b1", 0, 2, (("a", 0, 1, 0.9, True), ("x", 0, 2, 0.8, False), ("c", 0, 3, 0.7, True), ("d", 0, 4, 0.6, True)))
    two = selection.Supply("b2", 1, 5, (("c", 0, 1, 0.9, True), ("e", 0, 2, 0.5, True)))
    claims, lineage, summaries = selection.claim(corridor_rows, [two, one], 5)
    assert [(c["example_id"], c["source"], c["backfilled"]) for c in claims] == [("a", "0", False), ("c", "b1", True), ("d", "b1", True), ("e", "b2", True)]
    assert [(x["skipped"][0], x["reason"], x["replacement"] and x["replacement"][0]) for x in lineage] == [("a", "corridor_collision", "c"), ("x", "ineligible", "d"), ("c", "global_collision", "e")]
    assert [s["exhausted"] for s in summaries] == [False, True]
    rows = selection.records(claims)
    assert rows[0][4] == f"{selection.CORRIDOR},{selection.GLOBAL}" and rows[0][8] and rows[1][6] == "b1,b2"


def walk(corridor_rows, supplies, total):
    """The claims by their definition, one candidate at a time."""
    owner, sources, pairs = {(e, p): "corridor" for _, _, e, p, _ in sorted(corridor_rows)}, [], []
    for b in sorted(supplies, key=lambda b: (b.priority, b.board_id)):
        room, queue = min(b.requested, max(0, total - len(owner))), []
        for e, p, rank, _, able in b.candidates:
            if room == 0:
                break
            if not able or (e, p) in owner:
                queue.append((e, p))
                continue
            owner[e, p], room = "global", room - 1
            sources.append((e, p, b.board_id))
            if queue:
                pairs.append((b.board_id, queue.pop(0), (e, p)))
        pairs += [(b.board_id, x, None) for x in queue]
    return list(owner), sources, sorted(pairs, key=str)


def test_claims_equal_a_walk_over_random_boards():
    rng = np.random.default_rng(11)
    for _ in range(200):
        coordinates = [(f"e{rng.integers(0, 8)}", int(rng.integers(0, 3))) for _ in range(30)]
        corridor_rows = [(k % 3, k, *c, 0.5) for k, c in enumerate(dict.fromkeys(coordinates[: rng.integers(0, 6)]))]
        supplies = [selection.Supply(f"b{k}", int(rng.integers(0, 2)), int(rng.integers(0, 7)), tuple((*coordinates[i], n + 1, 1.0 - n / 9, bool(rng.random() < 0.8)) for n, i in enumerate(rng.integers(0, 30, rng.integers(0, 12))))) for k in range(4)]
        for total in (4, 9, 20):
            claims, lineage, summaries = selection.claim(corridor_rows, supplies, total)
            order, sources, pairs = walk(corridor_rows, supplies, total)
            assert [(c["example_id"], c["position"]) for c in claims] == order
            assert [(c["example_id"], c["position"], c["source"]) for c in claims if c["primary"] == selection.GLOBAL] == sources
            assert sorted(((x["board_id"], x["skipped"], x["replacement"]) for x in lineage), key=str) == pairs
            assert sum(s["fulfilled"] for s in summaries) == len(sources) and sum(s["backfills"] for s in summaries) == sum(y is not None for _, _, y in pairs) == sum(c["backfilled"] for c in claims)


def test_claims_reject_a_coordinate_of_two_modes():
    with pytest.raises(ValueError, match="more than one mode"):
        selection.claim([(0, 1, "a", 0, 0.9), (1, 1, "a", 0, 0.8)], [], 5)


def pool_frame(entries, capacity):
    rows = []
    for board, (priority, seen, cands) in entries.items():
        for k, (e, s) in enumerate(sorted(cands, key=lambda x: (-x[1], x[0]))[: 4 * capacity]):
            rows.append((board, priority, seen, k + 1, s, e, 0))
    return pd.DataFrame(rows, columns=["board_id", "priority", "seen", "rank", "score", "example_id", "position"])


def test_winner_stays_where_it_is_strongest_and_others_backfill():
    got = boards.assign_winners(pool_frame({"low_confidence": (1, "a", [("a", 0.9), ("b", 0.5)]), "global_max_entropy": (0, "a", [("c", 3.0), ("a", 2.0), ("d", 1.0)])}, 2), 2)
    assert sorted(zip(got["board_id"], got["example_id"], strict=True)) == [("global_max_entropy", "c"), ("global_max_entropy", "d"), ("low_confidence", "a"), ("low_confidence", "b")]


def test_winners_are_disjoint_and_full_for_random_pools():
    rng = np.random.default_rng(4)
    for _ in range(30):
        names = [f"e{k:02d}" for k in range(20)]
        entries = {b: (p, "e00", [(e, float(rng.integers(0, 9))) for e in names if rng.random() < 0.7]) for p, b in enumerate(["g", "h", "i"])}
        frame = pool_frame(entries, 3)
        got = boards.assign_winners(frame, 3)
        assert got["example_id"].is_unique
        taken = set(got["example_id"])
        for b, (_, _, cands) in entries.items():
            mine = got[got["board_id"] == b]
            free = set(frame[frame["board_id"] == b]["example_id"]) - taken
            assert len(mine) == 3 or not free
        again = boards.assign_winners(frame.sample(frac=1, random_state=1), 3)
        assert again.equals(got)


def test_winners_equal_rounds_of_moves():
    """Rounds until nothing moves: coordinates held twice stay where they are strongest, then free places are filled in board order."""
    rng = np.random.default_rng(8)
    for _ in range(60):
        entries = {b: (p, str(p), [(f"e{k}", float(rng.integers(0, 5))) for k in range(12) if rng.random() < 0.6]) for p, b in enumerate("ghij")}
        frame = pool_frame(entries, 2)
        rank = {(r.board_id, r.example_id): (r.rank, -r.score, r.priority) for r in frame.itertuples()}
        lists = {b: [e for (x, e) in sorted(rank, key=rank.get) if x == b] for b in entries}
        hold, before = {b: set(lists[b][:2]) for b in entries}, None
        while hold != before:
            before = {b: set(x) for b, x in hold.items()}
            for e in {e for x in hold.values() for e in x}:
                at = sorted((b for b in hold if e in hold[b]), key=lambda b: rank[b, e])
                for b in at[1:]:
                    hold[b].discard(e)
            for b in entries:
                free = [e for e in lists[b] if not any(e in x for x in hold.values())]
                hold[b] |= set(free[: 2 - len(hold[b])])
        got = boards.assign_winners(frame, 2)
        assert {(r.board_id, r.example_id) for r in got.itertuples()} == {(b, e) for b, x in hold.items() for e in x}


def test_budget_orders_by_rank_before_id(spark):
    scores = spark.createDataFrame([("low_confidence", 0.9, "z", 0), ("low_confidence", 0.8, "a", 0), ("low_confidence", 0.7, "b", 0)], "board_id string, score double, example_id string, position int")
    got = boards.select_exemplars(scores, 4, budget=2).orderBy("selection_rank").collect()
    assert [r["example_id"] for r in got] == ["z", "a"]


def test_reductions_account_for_all_mass():
    rng = np.random.default_rng(0)
    for v in (32, 61, 64):
        out = reduce.reduce_rows(rng.normal(0, 4, (50, v)), reduce.Reduction())
        assert np.allclose(out["top_mass"] + out["rank_bucket_mass"].sum(1), 1) and np.allclose(out["dynamic_mass"] + out["dynamic_bucket_mass"].sum(1), 1)
        assert ((out["dynamic_k"] >= 1) & (out["dynamic_k"] <= 32)).all() and (out["pair_count"].sum(1) == v - 8).all()
        p, _ = reduce.softmax(rng.normal(0, 4, (1, v)))
        tail = np.sort(p[0])[::-1][8:]
        assert np.allclose(reduce.rank_buckets(np.sort(p)[:, ::-1], np.array([8]), 4)[0], [g.sum() for g in np.array_split(tail, 4)])
    flat = reduce.reduce_rows(np.zeros((1, 64)), reduce.Reduction(most=16))
    assert flat["dynamic_k"][0] == 16 and flat["top_ids"][0].tolist() == list(range(8))


def test_published_mode_bounds():
    """64 texts' worth of padded positions of the deterministic teacher lie within the published bounds of its one mode."""
    token, position = np.meshgrid(np.arange(0, 130), np.arange(64))
    v = np.arange(512)
    x = np.sin(0.13 * token.ravel()[:, None] + 0.07 * position.ravel()[:, None] + 0.17 * v) + np.cos(0.11 * v) + 0.001 * position.ravel()[:, None]
    out = reduce.reduce_rows(x, reduce.Reduction())
    assert out["entropy"].min() == pytest.approx(5.8086, abs=2e-3) and out["entropy"].max() == pytest.approx(5.8316, abs=2e-3)
    assert out["top32_mass"].min() > 0.2290 and out["top32_mass"].max() < 0.2506


def test_shallow_statistics_are_an_error(spark):
    with pytest.raises(Exception, match="32 probabilities"):
        reduce.reduce_logits(reduce.synthetic_logits(spark, 16, 2)).collect()


def test_bins_and_buckets(spark):
    row = spark.range(1).select(
        *(B.bin_index(F.lit(x), B.TOP32_EDGES).alias(f"b{k}") for k, x in enumerate((-1.0, 0.49, 0.5, 0.999, 1.0))), B.place_bucket(F.lit(0), F.lit(1)).alias("p0"), B.place_bucket(F.lit(6), F.lit(8)).alias("p1"), B.quarter(F.lit(7), F.lit(8)).alias("q"), B.board_priority(F.lit("shard_coverage:3")).alias("s"),
    ).first()
    assert tuple(row) == (0, 0, 1, 3, 4, "final", "late", 3, 7)


def test_modes_stay_few_and_weights_agree(spark):
    stats = corridor.with_bins(reduce.reduce_logits(reduce.synthetic_logits(spark, 64, 16, 8.0)).select("token", "position", *corridor.STATS, "confidence", "top_token"))
    docs = spark.createDataFrame([(k, f"text number {k} with some words") for k in range(30)], "doc_id long, text string")
    at = corridor.token_positions(docs, 16, 64)
    one = corridor.modes(corridor.observe(at, stats)).collect()
    two = corridor.modes(at.groupBy("token", "position").agg(F.count(F.lit(1)).alias("n")).join(stats, ["token", "position"]), "n").collect()
    assert 1 < len(one) < 20
    for a, b in zip(sorted(one), sorted(two), strict=True):
        assert tuple(a) == pytest.approx(tuple(b))


def test_tail_classes_tags_and_caps(spark):
    ks = spark.createDataFrame([(k,) for k in (1, 8192, 32768, 65536, 262144)], "k int").withColumn("c", longtail.classify(F.col("k"), 262144)).withColumn("board", longtail.board_of(F.col("c")))
    assert [r["c"] for r in ks.orderBy("k").collect()] == list(longtail.CLASSES)
    assert [r["board"] for r in ks.orderBy("k").collect()] == ["primary", "long_tail_uncertainty", "long_tail_uncertainty", "perverse_tail_diagnostic", "perverse_tail_diagnostic"]
    assert longtail.cap_boards(ks, {"long_tail_uncertainty": 1}, ("k",)).count() == 4
    pieces = spark.createDataFrame([(p,) for p in ("http://x", "12.5", "Paris", "f(x)", "word", "McX", "<b>")], "piece string")
    assert [r[0] for r in pieces.select(longtail.piece_tag(F.col("piece"))).collect()] == ["url_or_markup_tail", "numeric_tail", "proper_name_tail", "code_or_symbol_tail", "unknown_open_class_tail", "proper_name_tail", "url_or_markup_tail"]


def test_winners_over_tables_equal_winners_in_one_frame(spark):
    """Many random boards, so that places freed on one take coordinates off several others, and rounds follow rounds."""
    rng = np.random.default_rng(11)
    for n in (5, 9):
        frame = pool_frame({f"b{k}": (k % 3, f"e{k % 2}", [(f"e{e:02d}", float(rng.integers(0, 6))) for e in range(40) if rng.random() < 0.5]) for k in range(n)}, 3)
        got = boards.winners(spark.createDataFrame(frame), 3).collect()
        want = boards.assign_winners(frame.copy(), 3)
        assert {(r["board_id"], r["example_id"], r["rank"], r["boards"]) for r in got} == {(r.board_id, r.example_id, r.rank, r.boards) for r in want.itertuples()} and len(got) == len(want)


def test_exemplars_equal_the_ranking_in_one_frame_and_may_be_none(spark):
    rng = np.random.default_rng(12)
    rows = [(b, float(rng.integers(0, 9)), f"e{e:02d}", int(p)) for b in ("global_max_entropy", "low_confidence", "shard_coverage:0", "shard_coverage:1") for e in range(25) for p in range(2) if rng.random() < 0.5]
    scores = spark.createDataFrame(rows, "board_id string, score double, example_id string, position int")
    pool = boards.pools(scores, 4).join(scores.groupBy("board_id").agg(F.min("example_id").alias("seen")), "board_id").toPandas()
    won = boards.assign_winners(pool, 4)
    order = sorted((r.rank, r.priority, -r.score, -r.boards, r.example_id, r.position) for r in won.itertuples())
    ranks = {e: k + 1 for k, e in enumerate(dict.fromkeys(x[4] for x in order))}
    for budget, fraction, most in ((None, None, len(ranks)), (3, None, 3), (None, 0.5, -(-len(ranks) // 2))):
        got = boards.select_exemplars(scores, 4, budget, fraction).collect()
        assert {(r["selection_rank"], r["example_id"], r["position"], r["board_id"]) for r in got} == {(ranks[r.example_id], r.example_id, r.position, r.board_id) for r in won.itertuples() if ranks[r.example_id] <= most}
    assert boards.select_exemplars(scores.limit(0), 4, 3, 0.5).count() == 0


def test_claims_read_boards_until_the_total_is_reached(spark):
    rows = [(f"b{k:03d}", f"e{k}{i}", i, i + 1, 1.0 - i / 9) for k in range(40) for i in range(3)]
    supply = spark.createDataFrame(rows, "board_id string, example_id string, position int, rank int, score double")
    pulled = []
    claims, _, summaries = selection.claim([], (pulled.append(b.board_id) or b for b in selection.supplies(supply, 2)), 5, ordered=True)
    assert len(claims) == 5 and [s["fulfilled"] for s in summaries] == [2, 2, 1] and len(pulled) == 4
    assert [r[0] for r in selection.unreached(supply, summaries).orderBy("board_id").collect()] == [f"b{k:03d}" for k in range(3, 40)]
    whole = [selection.Supply(b, 0, 2, tuple(r[1:] + (True,) for r in rows if r[0] == b)) for b in sorted({r[0] for r in rows})]
    assert selection.claim([], whole, 5)[0] == claims and selection.claim([], whole, 5)[2][:3] == summaries

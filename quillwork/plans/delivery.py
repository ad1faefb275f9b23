"""Named queries of the delivery layer over the test tables, whole tables each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.operators import audit, boards, corpus, delivery, package, selection
from quillwork.plans import catalog as C
from quillwork.plans import oracle as O

BUDGET, BYTES, GRID, SHARD_ROWS = 64, 1_000_000, 4, 128


def passport_join(spark, sf_dir):
    """Documents as claims, their modes by length; labels as passports."""
    docs, labels = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels")
    claims = docs.select("doc_id", F.when(F.col("lang") != "es", F.col("n_chars") % 2).cast("int").alias("mode_id"))
    passports = labels.select("doc_id", F.col("quality").alias("corridor_mode_id"), F.when(F.col("toxic") == 1, "unassigned").otherwise("linked").alias("corridor_assignment_status"))
    return delivery.attach_passports(claims, passports, ["doc_id"])


def grid_completeness(spark, sf_dir):
    """Line items as the assignments of orders, which should have four positions each."""
    cells = C.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("example_id"), (F.col("l_linenumber") - 1).alias("position"))
    return delivery.grid_audit(cells, C.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("example_id"), F.lit(GRID).alias("length")))


def three_collections(spark, sf_dir):
    docs, labels, vectors = (C.table(spark, sf_dir, n) for n in ("documents", "labels", "embeddings"))
    found = {
        "obligation": docs.select("doc_id", F.col("doc_id").alias("selection_index")), "passport": labels.select("doc_id", F.col("doc_id").alias("selection_index")),
        "payload": vectors.select(F.col("vec_id").alias("doc_id"), (F.col("vec_id") + (F.col("label") == 0).cast("int")).alias("selection_index")),
    }
    return delivery.collections_agree(found, ["doc_id"], ["selection_index"])


def _pool(spark, sf_dir):
    return boards.pools(C.board_scores(spark, sf_dir), C.CAPACITY)


def ranked_parity(spark, sf_dir):
    pool = _pool(spark, sf_dir)
    return delivery.compare_ranked(pool.where("board_id = 'global_max_entropy'"), pool.where("board_id = 'low_confidence'"))


def row_index_digests(spark, sf_dir):
    rows = C.deduplicated(spark, sf_dir).select("corpus_id", "content_hash", "ord")
    sharded = package.shard_rows(rows, F.col("ord") - 1, SHARD_ROWS)
    return delivery.index_rows(sharded, delivery.shard_digests(sharded, "content_hash")).select("corpus_id", "shard_id", "row_in_shard", "shard_sha256")


def split_leakage(spark, sf_dir):
    rows = C.chunks(spark, sf_dir).select("content_hash", corpus.round_robin(F.col("doc_id")).alias("split"))
    return delivery.split_overlap(rows, "content_hash", "split")


def _plan(spark, sf_dir):
    rows = C.scored(spark, sf_dir)
    pool = C.pools_of_modes(spark, sf_dir, rows)
    return selection.allocate(selection.mode_counts(rows, "n"), pool), pool


def c3_plan_totals(spark, sf_dir):
    return delivery.plan_totals(_plan(spark, sf_dir)[0], selection.Budget().corridor_ceiling)


def c6_coverage(spark, sf_dir):
    return delivery.coverage(*_plan(spark, sf_dir))


def _obligations(spark, sf_dir):
    modes = C.pools_of_modes(spark, sf_dir, C.scored(spark, sf_dir))
    corridors = modes.select("example_id", "position", F.lit("corridor").alias("role"), F.col("mode_id").cast("string").alias("source_id"))
    return corridors.unionByName(_pool(spark, sf_dir).select("example_id", "position", F.lit("global").alias("role"), F.col("board_id").alias("source_id")))


def c5_obligation_summary(spark, sf_dir):
    return delivery.obligation_summary(_obligations(spark, sf_dir))


def c6_supply_diagnostics(spark, sf_dir):
    return delivery.supply_diagnostics(_obligations(spark, sf_dir), BUDGET)


def merged_candidates(spark, sf_dir):
    modes = C.pools_of_modes(spark, sf_dir, C.scored(spark, sf_dir))
    corridors = modes.select(F.col("utility").alias("score"), F.concat(F.lit("corridor:"), F.col("mode_id").cast("string")).alias("source"), "example_id", "position")
    return delivery.merge_candidates([corridors, _pool(spark, sf_dir).select("score", F.col("board_id").alias("source"), "example_id", "position")], "score", ("source", "example_id", "position")).select("merged_rank", "source", "example_id", "position")


def byte_accounts(spark, sf_dir):
    return delivery.byte_account(C.chunks(spark, sf_dir), ["source", "lang"], "text", BYTES)


def quality_per_byte(spark, sf_dir):
    groups = C.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_discount").alias("a"), F.avg("l_tax").alias("b"), F.sum("l_quantity").alias("size"))
    out = groups.select("l_returnflag", "l_linestatus", *delivery.quality_per_byte(F.col("a"), F.col("b"), F.col("size")))
    return out.select("l_returnflag", "l_linestatus", *C.r6("absolute_delta", "relative_delta", "delta_per_mb"))


def entropy_closeness(spark, sf_dir):
    rows = C.binned_pairs(spark, sf_dir)
    coarse = F.round("entropy", 2)
    return rows.select("token", "position", F.round(delivery.entropy_delta(F.col("entropy"), coarse), 6).alias("delta"), delivery.entropy_close(F.col("entropy"), coarse).alias("close"))


def timing_comparison(spark, sf_dir):
    """Prices of shipped and of open line items as the runs of a baseline and a candidate."""
    rows = C.table(spark, sf_dir, "lineitem")
    side = lambda s: delivery.timing_summary(rows.where(F.col("l_linestatus") == s), ["l_linenumber"], "l_extendedprice")
    return delivery.timing_verdict(side("F"), side("O"), ["l_linenumber"], 0.0, 0.01).select("l_linenumber", *C.r6("baseline_median", "candidate_median"), "improved", "regressed")


def timing_summaries(spark, sf_dir):
    return delivery.timing_summary(C.table(spark, sf_dir, "events"), ["event_type"], "value").select("event_type", "runs", *C.r6("median", "spread", "normalized_spread"))


def store_inspection(spark, sf_dir):
    return delivery.inspect_arrays(C.table(spark, sf_dir, "embeddings"), ["embedding"])


def valid_positions(spark, sf_dir):
    rows = corpus.chunk_documents(C.documents(spark, sf_dir), C.WIDTH)
    rows = rows.withColumn("length", F.when(F.col("lang") == "en", F.col("char_count") + 10)).withColumn("mask", F.when(F.col("lang") == "fr", F.array_repeat(F.lit(1), F.col("char_count"))))
    valid = delivery.valid_length(F.col("length"), F.col("mask"), C.WIDTH)
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("examples"), F.sum(valid).cast("long").alias("positions"))


def gathered_rows(spark, sf_dir):
    """The rows of the teacher's table that the examples' strongest positions ask for."""
    wanted = C.example_summary(spark, sf_dir).select("token", "position").distinct()
    return delivery.gather(C.binned_stats(spark), wanted, ["token", "position"]).select("token", "position", "top_token", *C.r6("entropy"))


def bucket_check(spark, sf_dir):
    """Bucket arrays of all seen pairs, of which four fifths are damaged, each fifth its own way."""
    kind = F.col("token") % 5
    rows = C.seen_pairs(spark, sf_dir).select(
        "top_mass", "tail_mass", F.transform("pair_mass", lambda x: F.when(kind == 1, -x).otherwise(x)).alias("bucket_mass"), F.transform("pair_count", lambda x, k: x + ((kind == 0) & (k == 0)).cast("long")).alias("bucket_count"),
        F.transform("pair_logp", lambda x: F.when(kind == 2, -x).when(kind == 3, x - 1).otherwise(x)).alias("bucket_logp"),
    )
    return delivery.check_buckets(rows, C.VOCABULARY - C.SPEC.top_k)


def topk_faults(spark, sf_dir):
    """Top-k rows of all seen pairs, damaged by token and by position; topk_check reads them undamaged."""
    kind, place = F.col("token") % 5, F.col("position") % 6
    second = F.when(kind == 0, C.VOCABULARY).when(kind == 1, F.element_at("top_ids", 1))
    rows = C.seen_pairs(spark, sf_dir).select(
        F.transform("top_ids", lambda x, k: F.when((k == 1) & (kind < 2), second).otherwise(x)).alias("top_ids"), F.when(kind == 2, F.reverse("top_probs")).otherwise(F.col("top_probs")).alias("top_probs"),
        "top_mass", F.when(place == 0, F.col("tail_mass") + 0.5).otherwise(F.col("tail_mass")).alias("tail_mass"), F.when(place == 1, -F.col("entropy")).otherwise(F.col("entropy")).alias("entropy"),
    )
    return audit.check_top_k(rows, C.VOCABULARY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        passport_join, grid_completeness, three_collections, ranked_parity, row_index_digests, split_leakage, c3_plan_totals, c6_coverage, c5_obligation_summary, c6_supply_diagnostics, merged_candidates, byte_accounts,
        quality_per_byte, entropy_closeness, timing_comparison, timing_summaries, store_inspection, valid_positions, gathered_rows, bucket_check, topk_faults,
    )
}

_ROLES = f"""{O._C2}, {O._POOLS}, duty AS (SELECT example_id, position, 'corridor' AS role FROM c2 UNION ALL SELECT example_id, position, 'global' FROM pool),
    each AS (SELECT example_id, position, count(*) AS n, count(*) FILTER (role = 'corridor') AS c, count(*) FILTER (role = 'global') AS g FROM duty GROUP BY ALL)"""
_MEDIAN = "SELECT l_linenumber, CAST(quantile_cont(l_extendedprice, 0.5) AS DOUBLE) AS m, max(l_extendedprice) - min(l_extendedprice) AS s FROM lineitem WHERE l_linestatus = '{}' GROUP BY ALL"

ORACLE_SQL: dict[str, str] = {
    "passport_join": """WITH c AS (SELECT doc_id, CASE WHEN lang <> 'es' THEN CAST(n_chars % 2 AS INTEGER) END AS mode_id FROM documents), p AS (SELECT doc_id, quality, CASE WHEN toxic = 1 THEN 'unassigned' ELSE 'linked' END AS st FROM labels)
        SELECT c.doc_id, mode_id, coalesce(mode_id, quality) AS corridor_mode_id, CASE WHEN mode_id IS NOT NULL THEN 'linked' ELSE coalesce(st, 'not_applicable') END AS corridor_assignment_status,
               CASE WHEN p.doc_id IS NULL THEN 'passport_missing' WHEN mode_id <> quality THEN 'mode_mismatch' WHEN mode_id IS NOT NULL AND st <> 'linked' THEN 'not_linked' ELSE 'ok' END AS passport_status FROM c LEFT JOIN p ON c.doc_id = p.doc_id""",
    "grid_completeness": f"""WITH c AS (SELECT l_orderkey AS k, l_linenumber - 1 AS p, count(*) AS n FROM lineitem GROUP BY ALL), g AS (SELECT o_orderkey AS k, unnest(range(0, {GRID})) AS p FROM orders),
        f AS (SELECT coalesce(c.k, g.k) AS example_id, c.n, g.k IS NOT NULL AS planned FROM c FULL JOIN g ON c.k = g.k AND c.p = g.p),
        s AS (SELECT example_id, count(*) FILTER (planned AND n IS NULL) AS missing, count(*) FILTER (NOT planned) AS extra, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeated FROM f GROUP BY example_id)
        SELECT example_id, CASE WHEN o_orderkey IS NULL THEN NULL ELSE CAST({GRID} AS BIGINT) END AS length, missing, extra, repeated FROM s LEFT JOIN orders ON o_orderkey = example_id WHERE missing > 0 OR extra > 0 OR repeated > 0""",
    "three_collections": """WITH d AS (SELECT doc_id, count(*) AS n, min(doc_id) AS x FROM documents GROUP BY doc_id), l AS (SELECT doc_id, count(*) AS n, min(doc_id) AS x FROM labels GROUP BY doc_id),
        v AS (SELECT vec_id AS doc_id, count(*) AS n, min(vec_id + CAST(label = 0 AS INTEGER)) AS lo, max(vec_id + CAST(label = 0 AS INTEGER)) AS hi FROM embeddings GROUP BY vec_id),
        j AS (SELECT doc_id, d.n AS dn, l.n AS ln, v.n AS vn, least(d.x, l.x, v.lo) AS lo, greatest(d.x, l.x, v.hi) AS hi FROM d FULL JOIN l USING (doc_id) FULL JOIN v USING (doc_id)),
        r AS (SELECT doc_id, concat_ws(',', CASE WHEN dn IS NULL THEN 'obligation_missing' WHEN dn > 1 THEN 'obligation_duplicate' END, CASE WHEN ln IS NULL THEN 'passport_missing' WHEN ln > 1 THEN 'passport_duplicate' END,
              CASE WHEN vn IS NULL THEN 'payload_missing' WHEN vn > 1 THEN 'payload_duplicate' END, CASE WHEN lo <> hi THEN 'selection_index_differs' END) AS reasons FROM j) SELECT doc_id, reasons FROM r WHERE reasons <> ''""",
    "ranked_parity": f"""WITH {O._BOARDS}, a AS (SELECT CAST(rank AS INTEGER) AS rank, example_id AS le, position AS lp FROM pool WHERE board_id = 'global_max_entropy'), b AS (SELECT CAST(rank AS INTEGER) AS rank, example_id AS re, position AS rp FROM pool WHERE board_id = 'low_confidence')
        SELECT rank, CASE WHEN re IS NULL THEN 'left_only' WHEN le IS NULL THEN 'right_only' WHEN le = re AND lp = rp THEN 'matched' ELSE 'differs' END AS status, le AS left_example_id, lp AS left_position, re AS right_example_id, rp AS right_position FROM a FULL JOIN b USING (rank)""",
    "row_index_digests": f"""WITH {O._DEDUP}, s AS (SELECT (ord - 1) // {SHARD_ROWS} AS shard_id, sha256(string_agg(content_hash, chr(10) ORDER BY ord)) AS shard_sha256 FROM ids GROUP BY ALL)
        SELECT corpus_id, shard_id, (ord - 1) % {SHARD_ROWS} AS row_in_shard, shard_sha256 FROM ids JOIN s ON shard_id = (ord - 1) // {SHARD_ROWS}""",
    "split_leakage": f"""WITH {O._C400}, s AS (SELECT DISTINCT content_hash, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'calibration' ELSE 'final_test' END AS split FROM ch)
        SELECT a.split AS "left", b.split AS "right", count(*) AS shared FROM s a JOIN s b USING (content_hash) WHERE a.split < b.split GROUP BY ALL""",
    "c3_plan_totals": f"""WITH x AS ({O.SQL["c3_allocation"]}) SELECT CAST(16 AS BIGINT) AS ceiling, CAST(coalesce(sum(capacity), 0) AS BIGINT) AS capacity, CAST(coalesce(sum(slots), 0) AS BIGINT) AS allocated, count(*) AS modes,
        count(*) FILTER (capacity > 0) AS modes_able, count(*) FILTER (slots > 0) AS modes_allocated, count(DISTINCT zero_reason) AS zero_reasons FROM x""",
    "c6_coverage": f"""WITH x AS ({O.SQL["c3_allocation"]}), y AS ({O.SQL["c2_pools"]}), t AS (SELECT mode_id, count(*) AS claimed FROM x JOIN y USING (mode_id) WHERE rank <= slots GROUP BY mode_id)
        SELECT mode_id, slots, coalesce(claimed, 0) AS claimed, coalesce(claimed, 0) = slots AS fulfilled, CASE WHEN claimed IS NULL THEN coalesce(zero_reason, 'unfulfilled') END AS uncovered_reason FROM x LEFT JOIN t USING (mode_id)""",
    "c5_obligation_summary": f"WITH {_ROLES} SELECT count(*) AS coordinates, count(*) FILTER (c > 0) AS corridor_role, count(*) FILTER (g > 0) AS global_role, count(*) FILTER (n > 1) AS multi_role, CAST(sum(n) AS BIGINT) AS obligations FROM each",
    "c6_supply_diagnostics": f"""WITH {_ROLES}, s AS (SELECT count(*) FILTER (c > 0) AS corridor_unique, count(*) FILTER (g > 0) AS global_unique, count(*) FILTER (c > 0 AND g > 0) AS shared, count(*) AS either, CAST(sum(c) + sum(g) AS BIGINT) AS n FROM each)
        SELECT corridor_unique, global_unique, shared, either, n - corridor_unique - global_unique AS repeats, round(shared / CAST(greatest(either, 1) AS DOUBLE), 6) AS jaccard, greatest(0, {BUDGET} - either) AS shortfall,
               CASE WHEN either < {BUDGET} THEN 'insufficient_eligible_unique_candidates' END AS shortfall_reason FROM s""",
    "merged_candidates": f"""WITH {O._C2}, {O._POOLS}, u AS (SELECT utility AS score, 'corridor:' || mode_id AS source, example_id, position FROM c2 UNION ALL SELECT score, board_id, example_id, position FROM pool)
        SELECT row_number() OVER (ORDER BY score DESC, source, example_id, position) AS merged_rank, source, example_id, position FROM u""",
    "byte_accounts": f"WITH {O._C400}, b AS (SELECT source, lang, count(*) AS rows, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM ch GROUP BY ALL) SELECT *, bytes <= {BYTES} AS within FROM b",
    "quality_per_byte": """WITH g AS (SELECT l_returnflag, l_linestatus, avg(l_discount) AS a, avg(l_tax) AS b, sum(l_quantity) AS s FROM lineitem GROUP BY ALL)
        SELECT l_returnflag, l_linestatus, round(a - b, 6) AS absolute_delta, round((a - b) / greatest(abs(a), 1e-8), 6) AS relative_delta, round((a - b) / greatest(s / 1000000.0, 1e-8), 6) AS delta_per_mb FROM g""",
    "entropy_closeness": f"WITH {O._POS}, {O._STATS} SELECT token, position, round(abs(entropy - round(entropy, 2)), 6) AS delta, abs(entropy - round(entropy, 2)) <= 0.00390625 AS close FROM stat JOIN pairs USING (token, position)",
    "timing_comparison": f"""WITH a AS ({_MEDIAN.format("F")}), b AS ({_MEDIAN.format("O")})
        SELECT l_linenumber, round(a.m, 6) AS baseline_median, round(b.m, 6) AS candidate_median, a.m - b.m > 0 AS improved, b.m - a.m > greatest(0.01 * a.m, 0) AS regressed FROM a JOIN b USING (l_linenumber)""",
    "timing_summaries": """WITH t AS (SELECT event_type, count(value) AS runs, CAST(quantile_cont(value, 0.5) AS DOUBLE) AS m, max(value) - min(value) AS s FROM events GROUP BY ALL)
        SELECT event_type, runs, round(m, 6) AS median, round(s, 6) AS spread, round(CASE WHEN m = 0 AND s = 0 THEN 0 WHEN m <> 0 THEN s / m END, 6) AS normalized_spread FROM t""",
    "store_inspection": """SELECT 'embedding' AS "array", 'float' AS dtype, count(*) AS rows, CAST(min(len(embedding)) AS INTEGER) AS least_width, CAST(max(len(embedding)) AS INTEGER) AS most_width, count(*) FILTER (embedding IS NULL) AS nulls,
        CAST(coalesce(sum(len(list_filter(embedding, lambda x: NOT isfinite(x)))), 0) AS BIGINT) AS nonfinite FROM embeddings""",
    "valid_positions": f"WITH {O._chunks(64)} SELECT lang, count(*) AS examples, CAST(sum(CASE lang WHEN 'en' THEN least(char_count + 10, 64) WHEN 'fr' THEN char_count ELSE 64 END) AS BIGINT) AS positions FROM ch GROUP BY lang",
    "gathered_rows": f"WITH {O._OBS}, {O._SUMMARY} SELECT DISTINCT token, o.position, o.top_token, round(entropy, 6) AS entropy FROM obs o JOIN best b ON o.example_id = b.example_id AND o.position = b.position",
    "bucket_check": f"""WITH {O._POS}, {O._LONG}, t AS (SELECT token, position, token % 5 AS kind, sum(p) FILTER (r <= 8) AS top, coalesce(sum(p) FILTER (r > 8 AND p > 0.1), 0) AS m0, coalesce(sum(p) FILTER (r > 8 AND p <= 0.1), 0) AS m1, count(*) FILTER (r > 8 AND p > 0.1) AS n0,
            count(*) FILTER (r > 8 AND p <= 0.1) AS n1, coalesce(avg(lp) FILTER (r > 8 AND p > 0.1), 0) AS l0, coalesce(avg(lp) FILTER (r > 8 AND p <= 0.1), 0) AS l1 FROM ranked GROUP BY token, position),
        d AS (SELECT top, least(greatest(1 - top, 0), 1) AS tail, CASE WHEN kind = 1 THEN -m0 ELSE m0 END AS m0, CASE WHEN kind = 1 THEN -m1 ELSE m1 END AS m1, n0 + CAST(kind = 0 AS INTEGER) AS n0, n1,
              CASE kind WHEN 2 THEN -l0 WHEN 3 THEN l0 - 1 ELSE l0 END AS l0, CASE kind WHEN 2 THEN -l1 WHEN 3 THEN l1 - 1 ELSE l1 END AS l1 FROM t JOIN pairs USING (token, position))
        {" UNION ALL ".join(f"SELECT '{n}' AS check, count(*) FILTER ({c}) AS violations FROM d" for n, c in (("count_negative", "n0 < 0 OR n1 < 0"), ("mass_not_finite", "NOT isfinite(m0) OR NOT isfinite(m1)"), ("mass_negative", "m0 < 0 OR m1 < 0"), ("mean_not_finite", "NOT isfinite(l0) OR NOT isfinite(l1)"), ("empty_bucket_mean", "(n0 = 0 AND l0 <> 0) OR (n1 = 0 AND l1 <> 0)"), ("mean_positive", "(n0 <> 0 AND l0 > 0) OR (n1 <> 0 AND l1 > 0)"), ("count_sum", "n0 + n1 <> 56"), ("tail_mass_differs", "abs(m0 + m1 - tail) > 1e-3"), ("mass_not_one", "abs(top + m0 + m1 - 1) > 1e-3")))}""",
    "topk_faults": O._topk_checks(True),
}

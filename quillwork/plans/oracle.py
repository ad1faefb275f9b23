"""The same queries as DuckDB SQL, written from shared common table expressions."""

from __future__ import annotations

from quillwork.functions.text import BLANKS

_B = BLANKS.replace("'", "''")
_STRIP = rf"regexp_replace(%s, '\A[{_B}\x{{0a}}]+|[{_B}\x{{0a}}]+\z', '', 'g')"


def _strip(x: str) -> str:
    return _STRIP.replace("%s", x)


def _norm(x: str) -> str:
    lines = rf"regexp_replace(coalesce({x}, ''), '\r\n?', chr(10), 'g')"
    return _strip(rf"regexp_replace({lines}, '[{_B}]+\n', chr(10), 'g')")


def _chunks(width: int) -> str:
    return f"""norm AS (SELECT doc_id, lang, source, {_norm("text")} AS t FROM documents),
    parts AS (SELECT doc_id, lang, source, k, CASE WHEN length(t) <= {width} THEN t ELSE {_strip(f"substr(t, CAST(k * {width} + 1 AS BIGINT), {width})")} END AS text
              FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil(length(t) / {width}.0) AS BIGINT)))) AS k FROM norm WHERE length(t) > 0)),
    ch AS (SELECT doc_id, lang, source, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS chunk_index,
                  CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS chunk_count, CAST(length(text) AS INTEGER) AS char_count, 'sha256:' || sha256(text) AS content_hash
           FROM parts WHERE length(text) > 0)"""


_C400 = _chunks(400)
_DEDUP = f"""{_C400},
    first AS (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY doc_id, chunk_index) AS r FROM ch),
    kept AS (SELECT *, row_number() OVER (ORDER BY doc_id, chunk_index) AS ord FROM first WHERE r = 1),
    ids AS (SELECT *, printf('corpus_%09d', ord) AS corpus_id FROM kept)"""
_PROMPTS = """raw AS (SELECT d.doc_id, lang, quality, toxic,
        CASE WHEN quality IS NULL THEN '' WHEN d.doc_id % 10 = 0 THEN 'Val' WHEN d.doc_id % 10 = 1 THEN 'valid' ELSE ' Train ' END AS s FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    prompts AS (SELECT doc_id AS ord, printf('p%09d', doc_id) AS id, CASE WHEN lower(trim(s)) IN ('val', 'valid') THEN 'validation' WHEN trim(s) = '' THEN 'unspecified' ELSE lower(trim(s)) END AS split,
        list_filter([lang, CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS tags FROM raw)"""
_POS = f"""{_chunks(64)},
    pos AS (SELECT doc_id, doc_id // 1024 AS shard_id, printf('doc_%09d_%06d', doc_id, chunk_index) AS example_id, CAST(p AS INTEGER) AS position,
                   CAST(CASE WHEN p < length(text) THEN (unicode(substr(text, p + 1, 1)) + p) % 64 ELSE 0 END AS INTEGER) AS token
            FROM (SELECT *, unnest(range(0, 64)) AS p FROM ch)),
    pairs AS (SELECT token, position, count(*) AS n FROM pos GROUP BY ALL)"""
_LONG = """logit AS (SELECT CAST(token AS INTEGER) AS token, CAST(position AS INTEGER) AS position, v, 8.0 * (sin(0.13 * token + 0.07 * position + 0.17 * v) + cos(0.11 * v) + 0.001 * position) AS x
              FROM range(0, 64) a(token), range(0, 64) b(position), range(0, 64) c(v)),
    peak AS (SELECT token, position, max(x) AS m FROM logit GROUP BY ALL),
    ex AS (SELECT token, position, v, exp(x - m) AS e FROM logit JOIN peak USING (token, position)),
    tots AS (SELECT token, position, sum(e) AS s FROM ex GROUP BY ALL),
    prob AS (SELECT token, position, v, e / s AS p, ln(greatest(e / s, 1.1754943508222875e-38)) AS lp FROM ex JOIN tots USING (token, position)),
    ranked AS (SELECT *, row_number() OVER w AS r, sum(p) OVER (w ROWS UNBOUNDED PRECEDING) AS cum FROM prob WINDOW w AS (PARTITION BY token, position ORDER BY p DESC, v))"""
_STATS = f"""{_LONG},
    stat AS (SELECT CAST(token AS INTEGER) AS token, CAST(position AS INTEGER) AS position, round(-sum(p * lp), 9) AS entropy, CAST(min(CASE WHEN r = 1 THEN v END) AS INTEGER) AS top_token, round(max(p), 9) AS confidence,
             round(greatest(max(CASE WHEN r = 1 THEN p END) - max(CASE WHEN r = 2 THEN p END), 0), 9) AS top1_margin, round(least(greatest(sum(CASE WHEN r <= 8 THEN p ELSE 0 END), 0), 1), 9) AS top8_mass,
             round(least(greatest(sum(CASE WHEN r <= 32 THEN p ELSE 0 END), 0), 1), 9) AS top32_mass, round(greatest(1 - least(sum(CASE WHEN r <= 32 THEN p ELSE 0 END), 1), 0), 9) AS stat_tail_mass
             FROM ranked GROUP BY token, position)"""


def _bin(x: str, edges: tuple[float, ...]) -> str:
    return "CASE " + " ".join(f"WHEN greatest({x}, 0) < {e} THEN {k}" for k, e in enumerate(edges)) + f" ELSE {len(edges)} END"


def _entropy(x: str) -> str:
    return f"CASE WHEN {x} < 1 THEN 'low' WHEN {x} < 3 THEN 'mid' WHEN {x} < 6 THEN 'high' ELSE 'very_high' END"


def _confidence(x: str) -> str:
    return f"CASE WHEN {x} >= 0.75 THEN 'high' WHEN {x} >= 0.35 THEN 'mid' WHEN {x} >= 0.10 THEN 'low' ELSE 'very_low' END"


def _place(x: str, n: int) -> str:
    return f"CASE WHEN {x} >= {n - 1} THEN 'final' WHEN {x} / CAST({n - 1} AS DOUBLE) < 0.33 THEN 'early' WHEN {x} / CAST({n - 1} AS DOUBLE) < 0.66 THEN 'middle' ELSE 'late' END"


_OBS = f"""{_POS}, {_STATS},
    binned AS (SELECT *, {_bin("entropy", (1.0, 2.5, 4.0, 8.0))} AS entropy_bin, {_bin("top1_margin", (0.05, 0.15, 0.35, 1.0))} AS margin_bin, {_bin("top32_mass", (0.5, 0.75, 0.9, 1.0))} AS top32_bin,
                      {_entropy("entropy")} AS entropy_bucket, {_confidence("confidence")} AS confidence_bucket, {_place("position", 64)} AS place_bucket FROM stat),
    obs AS (SELECT * FROM pos JOIN binned USING (token, position))"""
_S = ("entropy", "top1_margin", "top8_mass", "top32_mass", "stat_tail_mass")


def _bounds() -> str:
    out = []
    for s in _S:
        lo, hi = f"min({s})", f"max({s})"
        for k, wide, narrow in (("min", lo, f"({lo} + {hi}) / 2 - 5e-7"), ("max", hi, f"({lo} + {hi}) / 2 + 5e-7"), ("mean", f"avg({s})", f"avg({s})")):
            x = f"greatest(0, CASE WHEN {hi} - {lo} < 1e-6 THEN {narrow} ELSE {wide} END)"
            out.append(f"{x if s == 'entropy' else f'least(1, {x})'} AS {s}_{k}")
    return ", ".join(out)


_MODES = f"""{_OBS},
    modes AS (SELECT CAST(row_number() OVER (ORDER BY entropy_bin, margin_bin, top32_bin) - 1 AS INTEGER) AS mode_id, entropy_bin, margin_bin, top32_bin, count(*) AS n, count(*) / sum(count(*)) OVER () AS share, {_bounds()}
              FROM obs GROUP BY entropy_bin, margin_bin, top32_bin)"""
_ASSIGNED = f"""{_MODES},
    assigned AS (SELECT obs.*, mode_id FROM obs JOIN modes USING (entropy_bin, margin_bin, top32_bin))"""
_SUMMARY = """best AS (SELECT example_id, doc_id, shard_id, max(entropy) AS max_entropy, round(avg(entropy), 9) AS mean_entropy, arg_min(position, (-entropy, position)) AS position, arg_min(confidence, (-entropy, position)) AS confidence,
                    arg_min(top_token, (-entropy, position)) AS top_token FROM obs GROUP BY ALL)"""
_POOLS = f"""{_SUMMARY},
    scores AS (SELECT 'global_max_entropy' AS board_id, 0 AS priority, round(max_entropy, 9) AS score, example_id, position FROM best
        UNION ALL SELECT 'global_mean_entropy', 4, round(mean_entropy, 9), example_id, position FROM best
        UNION ALL SELECT 'low_confidence', 1, round(1 - confidence, 9), example_id, position FROM best
        UNION ALL SELECT 'position_bucket_entropy:' || least(3, CAST(floor(position / 64.0 * 4) AS INTEGER)), 5, round(max_entropy, 9), example_id, position FROM best
        UNION ALL SELECT 'length_bucket_entropy:1', 6, round(max_entropy, 9), example_id, position FROM best
        UNION ALL SELECT 'shard_coverage:' || shard_id, 7, round(max_entropy, 9), example_id, position FROM best),
    pool AS (SELECT *, row_number() OVER (PARTITION BY board_id ORDER BY score DESC, example_id, position) AS rank FROM scores QUALIFY rank <= 64)"""
_BOARDS = f"{_OBS}, {_POOLS}"
_W = tuple(w / (0.45 + 0.40 + 0.15) for w in (0.45, 0.40, 0.15))
_C1 = f"""{_ASSIGNED},
    feat AS (SELECT a.example_id, a.token, a.position, mode_id, m.n AS mode_support,
                    round(greatest(0, least(1, 1 - abs(entropy - entropy_mean) / greatest(abs(entropy_mean - entropy_min), abs(entropy_max - entropy_mean), 1e-6))), 9) AS membership_score,
                    round(greatest(0, least(1, entropy / ln(64))), 9) AS useful_difficulty FROM assigned a JOIN modes m USING (mode_id)),
    dist AS (SELECT *, round(1 - membership_score, 9) AS d FROM feat),
    near AS (SELECT *, greatest(0, least(1, 1 - d / 0.5)) AS centrality_score,
                    concat_ws(',', CASE WHEN membership_score < 0.5 THEN 'membership_below_minimum' END, CASE WHEN d > 0.5 THEN 'outside_corridor_core' END, CASE WHEN mode_support < 1 THEN 'mode_support_below_minimum' END) AS reasons FROM dist),
    c1 AS (SELECT *, reasons = '' AS eligible, CASE WHEN reasons = '' THEN round({_W[0]!r} * membership_score + {_W[1]!r} * centrality_score + {_W[2]!r} * useful_difficulty, 9) END AS utility FROM near)"""
_C2 = f"""{_C1},
    c2 AS (SELECT *, row_number() OVER (PARTITION BY mode_id ORDER BY utility DESC, membership_score DESC, centrality_score DESC, useful_difficulty DESC, example_id, position) AS rank FROM c1 WHERE eligible QUALIFY rank <= 4),
    counts AS (SELECT mode_id, count(*) AS seen, CAST(sum(CAST(eligible AS INTEGER)) AS BIGINT) AS eligible, CAST(sum(CAST(NOT eligible AS INTEGER)) AS BIGINT) AS rejected, max(mode_support) AS mode_support FROM c1 GROUP BY mode_id)"""
_TAIL = """tails AS (SELECT *, CASE WHEN k >= 50 THEN 'full_vocab_or_near_full_vocab' WHEN k >= 45 THEN 'suspicious_flat' WHEN k >= 25 THEN 'very_long_tail' WHEN k >= 10 THEN 'long_tail' ELSE 'normal' END AS tail_class
    FROM (SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS k FROM lineitem))"""


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _edges(edges: tuple[float, ...], closed: bool) -> str:
    last = len(edges) - 2
    tests = []
    for b, (hi, lo) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        test = f"p <= {hi!r} AND p {'>=' if b == last else '>'} {lo!r}" if closed else f"p < {hi!r} AND p >= {lo!r}"
        tests.append(f"SELECT token, position, {b} AS bucket, round(coalesce(sum(p) FILTER ({test}), 0), 6) AS mass, count(*) FILTER ({test}) AS items, round(coalesce(avg(lp) FILTER ({test}), 0), 6) AS mean_logp FROM tail GROUP BY token, position")
    return f"WITH {_POS}, {_LONG}, tail AS (SELECT r.* FROM ranked r JOIN pairs USING (token, position) WHERE r > 8) " + " UNION ALL ".join(tests)


def _topk_checks(damaged: bool) -> str:
    """Faults of the top 8 of all seen pairs, from the ranked probabilities; or of the same rows damaged by token and position."""
    ids = "CASE token % 5 WHEN 0 THEN list_concat([ids[1], 64], ids[3:]) WHEN 1 THEN list_concat([ids[1], ids[1]], ids[3:]) ELSE ids END" if damaged else "ids"
    probs = "CASE WHEN token % 5 = 2 THEN list_reverse(probs) ELSE probs END" if damaged else "probs"
    tail = "tail + CASE WHEN position % 6 = 0 THEN 0.5 ELSE 0 END" if damaged else "tail"
    entropy = "CASE WHEN position % 6 = 1 THEN -entropy ELSE entropy END" if damaged else "entropy"
    checks = {
        "id_out_of_range": "len(list_filter(ids, lambda x: x < 0 OR x >= 64)) > 0", "duplicate_id": "len(list_distinct(ids)) < len(ids)", "not_descending": "len(list_filter(range(2, 9), lambda k: probs[k - 1] < probs[k])) > 0",
        "mass_out_of_range": "top NOT BETWEEN 0 AND 1.001 OR tail NOT BETWEEN 0 AND 1.001", "mass_not_one": "abs(top + tail - 1) > 1e-3", "negative_entropy": "entropy < 0",
    }
    return f"""WITH {_POS}, {_LONG}, l AS (SELECT token, position, list(v ORDER BY r) FILTER (r <= 8) AS ids, list(p ORDER BY r) FILTER (r <= 8) AS probs, sum(p) FILTER (r <= 8) AS top, -sum(p * lp) AS entropy FROM ranked GROUP BY token, position),
        m AS (SELECT *, least(greatest(1 - top, 0), 1) AS tail FROM l JOIN pairs USING (token, position)), d AS (SELECT {ids} AS ids, {probs} AS probs, top, {tail} AS tail, {entropy} AS entropy FROM m)
        """ + " UNION ALL ".join(f"SELECT '{n}' AS check, count(*) FILTER ({c}) AS violations FROM d" for n, c in checks.items())


SQL: dict[str, str] = {
    "corpus_normalize_chunk": f"WITH {_C400} SELECT doc_id, chunk_index, chunk_count, char_count, content_hash FROM ch",
    "corpus_exact_dedup": f"WITH {_DEDUP} SELECT corpus_id, doc_id, chunk_index, char_count, content_hash, lang FROM ids",
    "corpus_manifest_by_source": f"WITH {_DEDUP} SELECT source, count(*) AS row_count, CAST(sum(char_count) AS BIGINT) AS char_count, count(DISTINCT doc_id) AS source_count FROM ids GROUP BY source",
    "corpus_report_counters": f"""WITH {_C400}, s AS (SELECT count(*) AS sources_seen, (SELECT count(*) FROM norm WHERE length(t) < 1) AS sources_empty FROM documents),
        c AS (SELECT count(*) AS rows_before_dedup, count(DISTINCT content_hash) AS rows, count(DISTINCT doc_id) AS sources_included FROM ch)
        SELECT *, rows_before_dedup - rows AS duplicates_removed, CASE WHEN sources_seen > sources_included THEN 'warn' ELSE 'pass' END AS status FROM s, c""",
    "corpus_check": f"""WITH {_DEDUP} SELECT 'empty_text' AS check, count(*) FILTER (length(text) = 0) AS violations FROM ids UNION ALL SELECT 'hash_mismatch', count(*) FILTER ('sha256:' || sha256(text) <> content_hash) FROM ids
        UNION ALL SELECT 'length_mismatch', count(*) FILTER (length(text) <> char_count) FROM ids UNION ALL SELECT 'chunk_out_of_range', count(*) FILTER (NOT chunk_index BETWEEN 0 AND chunk_count - 1) FROM ids
        UNION ALL SELECT 'duplicate_id', count(*) FROM (SELECT corpus_id FROM ids GROUP BY corpus_id HAVING count(*) > 1)""",
    "prompt_filter_tags": f"WITH {_PROMPTS} SELECT id, split, array_to_string(tags, ',') AS tags FROM prompts WHERE split = 'validation' AND list_contains(tags, 'en') AND list_contains(tags, 'good')",
    "prompt_manifest": f"""WITH {_PROMPTS}, t AS (SELECT split, array_to_string(list_sort(list_distinct(flatten(list(tags)))), ',') AS tags FROM prompts GROUP BY split)
        SELECT split, count(*) AS prompts, any_value(t.tags) AS tags FROM prompts JOIN t USING (split) GROUP BY split""",
    "split_round_robin": "SELECT CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'calibration' ELSE 'final_test' END AS split, lang, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY ALL",
    "shard_assignment": f"WITH {_DEDUP} SELECT (ord - 1) // 1024 AS shard_id, ((ord - 1) // 1024) % 4 AS worker, count(*) AS rows, min(corpus_id) AS first_id, max(corpus_id) AS last_id, CAST(sum(char_count) AS BIGINT) AS chars FROM ids GROUP BY ALL",
    "stratified_sample": """WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), q AS (SELECT lang, 64 * n / CAST(sum(n) OVER () AS DOUBLE) AS q FROM c), a AS (SELECT lang, q, floor(q) AS a FROM q),
        s AS (SELECT lang, a + CASE WHEN row_number() OVER (ORDER BY q - a DESC, lang) <= 64 - sum(a) OVER () THEN 1 ELSE 0 END AS slots FROM a)
        SELECT doc_id, lang FROM (SELECT doc_id, d.lang, slots, row_number() OVER (PARTITION BY d.lang ORDER BY doc_id) AS r FROM documents d JOIN s ON d.lang = s.lang) WHERE r <= slots""",
    "cpu_tokens": f"WITH {_POS} SELECT token, position, n FROM pairs",
    "topk_tail": f"""WITH {_POS}, {_LONG}, t AS (SELECT token, position, array_to_string(list(v ORDER BY r) FILTER (r <= 8), ',') AS top_ids, sum(p) FILTER (r <= 8) AS top_mass, -sum(p * lp) AS entropy, max(p) AS confidence FROM ranked GROUP BY ALL)
        SELECT token, position, n, top_ids, round(top_mass, 6) AS top_mass, round(least(greatest(1 - top_mass, 0), 1), 6) AS tail_mass, {_r("entropy", "confidence")} FROM t JOIN pairs USING (token, position)""",
    "cascaded_rank_buckets": f"""WITH {_POS}, {_LONG}, b AS (SELECT token, position, p, ntile(4) OVER (PARTITION BY token, position ORDER BY p DESC, v) - 1 AS bucket FROM ranked WHERE r > 8)
        SELECT token, position, n, CAST(bucket AS INTEGER) AS bucket, round(sum(p), 6) AS mass FROM b JOIN pairs USING (token, position) GROUP BY ALL""",
    "cascaded_edge_buckets_pair": _edges((1.0, 0.1, 0.0), True),
    "cascaded_edge_buckets_ladder": _edges((1.0, 1e-3, 1e-6, 1e-9, 1e-12, 0.0), False),
    "dynamic_topk": f"""WITH {_POS}, {_LONG}, k AS (SELECT token, position, least(32, greatest(1, coalesce(min(r) FILTER (cum >= 0.95), 32))) AS dynamic_k FROM ranked GROUP BY ALL)
        SELECT token, position, n, CAST(dynamic_k AS INTEGER) AS dynamic_k, round(cum, 6) AS dynamic_mass, round(least(greatest(1 - cum, 0), 1), 6) AS dynamic_tail FROM k JOIN ranked USING (token, position) JOIN pairs USING (token, position) WHERE r = dynamic_k""",
    "dynamic_topk_summary": f"""WITH {_POS}, {_LONG}, k AS (SELECT token, position, CAST(least(32, greatest(1, coalesce(min(r) FILTER (cum >= 0.95), 32))) AS INTEGER) AS k FROM ranked GROUP BY ALL)
        SELECT min(k) AS least_k, max(k) AS most_k, round(sum(k * n) / CAST(sum(n) AS DOUBLE), 6) AS mean_k, CAST(sum(n) AS BIGINT) AS positions FROM k JOIN pairs USING (token, position)""",
    "topk_check": _topk_checks(False),
    "corridor_stats": f"WITH {_POS}, {_STATS} SELECT token, position, n, {_r('top1_margin', 'top8_mass', 'top32_mass', 'stat_tail_mass', 'entropy')} FROM stat JOIN pairs USING (token, position)",
    "example_entropy_summary": f"WITH {_OBS}, {_SUMMARY} SELECT example_id, position, top_token, {_r('max_entropy', 'mean_entropy')} FROM best",
    "exemplar_positions": f"WITH {_OBS} SELECT example_id, CAST(row_number() OVER (PARTITION BY example_id ORDER BY entropy DESC, position) AS INTEGER) AS rank, position, round(entropy, 6) AS entropy FROM obs QUALIFY rank <= 2",
    "corridor_modes": f"WITH {_MODES} SELECT mode_id, entropy_bin, margin_bin, top32_bin, n, {_r('share', *(f'{s}_{k}' for s in _S for k in ('min', 'max', 'mean')))} FROM modes",
    "mode_representatives": f"""WITH {_OBS} SELECT entropy_bin, margin_bin, top32_bin, CAST(row_number() OVER (PARTITION BY entropy_bin, margin_bin, top32_bin ORDER BY entropy DESC, example_id, position) AS INTEGER) AS rank, example_id, position, round(entropy, 6) AS entropy
        FROM obs QUALIFY rank <= 3""",
    "corridor_fingerprints": f"""WITH {_OBS}, g AS (SELECT top_token, entropy_bucket, confidence_bucket, place_bucket, count(*) AS n, count(DISTINCT example_id) AS examples, avg(entropy) AS mean_entropy, max(entropy) AS max_entropy, avg(confidence) AS mean_confidence FROM obs GROUP BY ALL)
        SELECT printf('fp_%06d', row_number() OVER (ORDER BY n DESC, top_token, entropy_bucket, confidence_bucket, place_bucket) - 1) AS fingerprint_id, top_token, entropy_bucket, confidence_bucket, place_bucket, n, examples, {_r("mean_entropy", "max_entropy", "mean_confidence")} FROM g""",
    "mode_assignments": f"WITH {_ASSIGNED} SELECT example_id, mode_id, count(*) AS n, min(position) AS first_position FROM assigned GROUP BY ALL",
    "link_selected_to_modes": f"""WITH {_ASSIGNED}, {_SUMMARY}, sel AS (SELECT example_id, position FROM best UNION ALL SELECT example_id, position + 64 FROM best)
        SELECT CASE WHEN mode_id IS NULL THEN 'missing' ELSE 'linked' END AS assignment_status, mode_id, count(*) AS n, min(example_id) AS first_example FROM sel LEFT JOIN assigned USING (example_id, position) GROUP BY ALL""",
    "boards_pools": f"WITH {_BOARDS} SELECT board_id, priority, CAST(rank AS INTEGER) AS rank, example_id, position, round(score, 6) AS score FROM pool",
    "duplicate_candidates": f"WITH {_BOARDS} SELECT example_id, position, count(DISTINCT board_id) AS boards FROM pool GROUP BY ALL HAVING count(DISTINCT board_id) > 1",
    "c1_scores": f"""WITH {_C1} SELECT token, position, mode_id, count(*) AS n, any_value(eligible) AS eligible, any_value(reasons) AS reasons, {", ".join(f"round(any_value({c}), 6) AS {c}" for c in ("membership_score", "centrality_score", "useful_difficulty", "utility"))} FROM c1 GROUP BY token, position, mode_id""",
    "c2_pools": f"WITH {_C2} SELECT mode_id, CAST(rank AS INTEGER) AS rank, example_id, position, {_r('utility', 'membership_score', 'centrality_score', 'useful_difficulty')} FROM c2",
    "c2_counts": f"WITH {_C2} SELECT * FROM counts",
    "c2_rejections": f"WITH {_C1} SELECT mode_id, reason, count(*) AS n FROM (SELECT mode_id, unnest(string_split(reasons, ',')) AS reason FROM c1 WHERE reasons <> '') GROUP BY ALL",
    "c2_pool_occupancy": f"WITH {_C2}, h AS (SELECT mode_id, count(*) AS n FROM c2 GROUP BY mode_id) SELECT min(n) AS least, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median, max(n) AS most, count(*) AS modes FROM h",
    "c3_allocation": f"""WITH {_C2}, held AS (SELECT mode_id, count(*) AS retained, max(utility) FILTER (rank = 1) AS u, max(membership_score) FILTER (rank = 1) AS m, max(centrality_score) FILTER (rank = 1) AS c FROM c2 GROUP BY mode_id),
        base AS (SELECT mode_id, seen, eligible, rejected, mode_support, coalesce(retained, 0) AS retained, coalesce(u, 0) AS u, coalesce(m, 0) AS m, coalesce(c, 0) AS c, CAST(least(10, coalesce(retained, 0), eligible) AS INTEGER) AS capacity FROM counts LEFT JOIN held USING (mode_id)),
        tot AS (SELECT *, least(16, sum(capacity) OVER ()) AS budget, sum(CASE WHEN capacity > 0 THEN 1 ELSE 0 END) OVER () AS able FROM base),
        slot AS (SELECT *, unnest(range(1, capacity + 1)) AS s FROM tot WHERE capacity > 0),
        few AS (SELECT mode_id, budget, row_number() OVER (ORDER BY u DESC, m DESC, c DESC, mode_support DESC, mode_id) AS place FROM slot WHERE s = 1 AND budget < able),
        many AS (SELECT mode_id, budget, row_number() OVER (ORDER BY s, mode_id) AS place FROM slot WHERE budget >= able),
        given AS (SELECT mode_id, count(*) AS slots FROM (SELECT * FROM few UNION ALL SELECT * FROM many) WHERE place <= budget GROUP BY mode_id)
        SELECT mode_id, capacity, coalesce(slots, 0) AS slots, retained, eligible, seen, rejected, mode_support, CASE WHEN coalesce(slots, 0) > 0 THEN NULL WHEN eligible = 0 AND seen = 0 THEN 'empty_candidate_pool' WHEN eligible = 0 THEN 'no_eligible_candidates'
            WHEN retained = 0 THEN 'empty_candidate_pool' WHEN capacity = 0 THEN 'mode_capacity_zero' ELSE 'corridor_budget_exhausted' END AS zero_reason FROM tot LEFT JOIN given USING (mode_id)""",
    "payload_keys": f"""WITH {_OBS}, {_SUMMARY} SELECT example_id, position, 'coordinate_v1:' || sha256('["' || example_id || '",' || position || ']') AS payload_key FROM best""",
    "longtail_classes": f"WITH {_TAIL} SELECT k AS effective_k, tail_class, count(*) AS n FROM tails GROUP BY ALL",
    "longtail_routing": f"""WITH {_TAIL}, b AS (SELECT *, CASE WHEN tail_class = 'normal' THEN 'primary' WHEN tail_class IN ('long_tail', 'very_long_tail') THEN 'long_tail_uncertainty' ELSE 'perverse_tail_diagnostic' END AS board FROM tails),
        c AS (SELECT *, row_number() OVER (PARTITION BY board ORDER BY l_orderkey, l_linenumber) AS r FROM b)
        SELECT board, count(*) AS n, CAST(sum(k) AS BIGINT) AS k_sum, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key FROM c WHERE board = 'primary' OR r <= CASE board WHEN 'long_tail_uncertainty' THEN 128 ELSE 32 END GROUP BY board""",
    "longtail_summary": f"""WITH {_TAIL} SELECT count(*) AS n, {", ".join(f"count(*) FILTER (tail_class = '{c}') AS n_{c}" for c in ("normal", "long_tail", "very_long_tail", "suspicious_flat", "full_vocab_or_near_full_vocab"))},
        count(*) FILTER (k >= 50) AS n_saturated, CAST(max(k) AS BIGINT) AS max_k, round(avg(k), 6) AS mean_k, round(max(k) / 50.0, 6) AS max_fraction FROM tails""",
    "semantic_tail_tags": r"""WITH p AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+')) AS piece FROM documents),
        t AS (SELECT doc_id, CASE WHEN regexp_matches(piece, '\A(http|www\.|<|#)|://|=|/') THEN 'url_or_markup_tail' WHEN regexp_matches(piece, '\A[\p{Nd}.,:%+\-/]*\z') THEN 'numeric_tail' WHEN regexp_matches(piece, '[{}\[\]()<>_=;`\\|~]') THEN 'code_or_symbol_tail'
                     WHEN regexp_matches(piece, '\A\p{Lu}\p{L}*\z|\A(Mc|Mac|O''|van|de)') THEN 'proper_name_tail' ELSE 'unknown_open_class_tail' END AS tag FROM p WHERE piece <> ''),
        c AS (SELECT doc_id, count(*) AS pieces, count(*) FILTER (tag = 'proper_name_tail') AS a, count(*) FILTER (tag = 'numeric_tail') AS b, count(*) FILTER (tag = 'url_or_markup_tail') AS u, count(*) FILTER (tag = 'code_or_symbol_tail') AS s FROM t GROUP BY doc_id)
        SELECT doc_id, pieces, CASE WHEN a * 2 >= pieces THEN 'proper_name_tail' WHEN b * 2 >= pieces THEN 'numeric_tail' WHEN u * 2 >= pieces THEN 'url_or_markup_tail' WHEN s * 2 >= pieces THEN 'code_or_symbol_tail' ELSE 'unknown_open_class_tail' END AS tag FROM c""",
    "parity_numeric_diff": """WITH x AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), y AS (SELECT label, x, round(x, 3) AS y FROM x)
        SELECT label, count(*) AS n, round(max(abs(x - y)), 9) AS max_abs, round(avg(abs(x - y)), 9) AS mean_abs, round(max(abs(x - y) / abs(x)) FILTER (abs(x) > 1e-6), 6) AS max_rel,
               round(avg(CASE WHEN abs(x - y) <= 1e-5 + 1e-4 * abs(x) THEN 1.0 ELSE 0.0 END), 6) AS within, count(*) FILTER (x IS NULL OR isnan(x)) AS n_odd FROM y GROUP BY label""",
    "selection_jaccard": f"""WITH {_BOARDS}, s AS (SELECT board_id, example_id, position FROM pool), n AS (SELECT board_id, count(*) AS n FROM s GROUP BY board_id),
        j AS (SELECT a.board_id AS "left", b.board_id AS "right", count(*) AS shared FROM s a JOIN s b USING (example_id, position) WHERE a.board_id < b.board_id GROUP BY ALL)
        SELECT "left", "right", shared, l.n + r.n - shared AS either, round(shared / (l.n + r.n - shared), 6) AS jaccard FROM j JOIN n l ON l.board_id = "left" JOIN n r ON r.board_id = "right" """,
    "coordinate_surface_diff": """WITH a AS (SELECT doc_id, count(*) AS left_n FROM documents GROUP BY doc_id), b AS (SELECT doc_id, count(*) AS right_n FROM labels GROUP BY doc_id)
        SELECT doc_id, coalesce(left_n, 0) AS left_n, coalesce(right_n, 0) AS right_n, CASE WHEN right_n IS NULL THEN 'missing' WHEN left_n IS NULL THEN 'extra' WHEN left_n > 1 OR right_n > 1 THEN 'duplicate' ELSE 'matched' END AS status FROM a FULL JOIN b USING (doc_id)""",
    "linkage_audit": f"""WITH p AS (SELECT doc_id, length({_norm("text")}) AS chars, lang FROM documents WHERE lang <> 'es'),
        j AS (SELECT d.doc_id, concat_ws(',', CASE WHEN p.doc_id IS NULL THEN 'payload_missing' END, CASE WHEN p.doc_id IS NOT NULL AND d.n_chars IS DISTINCT FROM p.chars THEN 'chars_mismatch' END,
              CASE WHEN p.doc_id IS NOT NULL AND d.lang <> CASE WHEN p.chars % 5 = 0 THEN upper(p.lang) ELSE p.lang END THEN 'lang_mismatch' END) AS reasons FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id)
        SELECT doc_id, reasons FROM j WHERE reasons <> ''""",
    "range_join_shards": """WITH r AS (SELECT k AS shard_id, 50 * k * k AS start, 50 * (k + 1) * (k + 1) AS fin FROM range(0, 100000) t(k))
        SELECT shard_id, start, count(*) AS n, min(o_orderkey - start) AS least_row, round(sum(CAST(o_totalprice AS DOUBLE)), 2) AS price FROM orders ASOF JOIN r ON o_orderkey >= start WHERE o_orderkey < fin GROUP BY ALL""",
    "lineage_join": """WITH l AS (SELECT DISTINCT doc_id FROM labels) SELECT source, count(*) AS n, count(l.doc_id) AS linked, count(*) - count(l.doc_id) AS missing FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id GROUP BY source""",
    "ordered_collection_root": """WITH h AS (SELECT source, doc_id, sha256(coalesce(text, '')) AS h FROM documents), f AS (SELECT source, doc_id // 1024 AS leaf, count(*) AS n, sha256(string_agg(h, chr(10) ORDER BY doc_id, h)) AS d FROM h GROUP BY ALL)
        SELECT source, count(*) AS leaves, CAST(sum(n) AS BIGINT) AS items, 'sha256:' || sha256(string_agg(d, chr(10) ORDER BY leaf)) AS root FROM f GROUP BY source""",
    "payload_shards": f"WITH {_DEDUP} SELECT (ord - 1) // 128 AS shard_id, min(corpus_id) AS first, max(corpus_id) AS last, count(*) AS rows FROM ids GROUP BY ALL",
    "chat_turns": f"SELECT role, count(*) AS turns, count(DISTINCT conv_id) AS conversations, CAST(sum(length({_norm('text')})) AS BIGINT) AS chars, max(turn) AS last_turn FROM conversations GROUP BY role",
    "bucket_ladders": f"""WITH g AS (SELECT CAST(trunc(l_quantity) AS INTEGER) AS q, CAST(l_discount AS DOUBLE) AS d, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT q, round(d, 4) AS d, n, least(3, CAST(floor((q - 1) / 50.0 * 4) AS INTEGER)) AS quarter, CASE WHEN q * 8 <= 16 THEN 0 WHEN q * 8 <= 64 THEN 1 WHEN q * 8 <= 256 THEN 2 ELSE 3 END AS length_class, {_place("(q - 1)", 50)} AS place,
               {_entropy("(q / 7.0)")} AS entropy, {_confidence("(d * 10)")} AS confidence, {_bin("(d * 10)", (0.05, 0.15, 0.35, 1.0))} AS margin_bin FROM g""",
}

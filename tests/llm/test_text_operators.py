from __future__ import annotations

import base64
import hashlib
import json
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as fx  # noqa: E402

from quillwork.llm import decontam, gam, hpylm, jaccard, packing, rules, secrets  # noqa: E402
from quillwork.llm.queries import tokenizer_path  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def der(tag: int, body: bytes) -> bytes:
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else b"\x82" + n.to_bytes(2, "big")) + body


KEY = der(0x30, der(2, b"\0") + b"".join(der(2, b"\1" * k) for k in (128, 3, 128, 64, 64, 64, 64, 64)))


def test_secrets_need_a_structure_that_holds():
    coded = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    token = f"{coded(json.dumps({'alg': 'HS256'}).encode())}.{coded(b'{}')}.{coded(b's' * 32)}"
    kinds = lambda t: [secrets.KINDS[k] for _, k, _ in secrets.find_secrets(t)]
    assert kinds(f"see {token} here") == ["signed_token"]
    assert kinds(f"see {token[:-3]} here") == []
    assert kinds(f"k {base64.b64encode(KEY).decode()}") == ["encoded_key"]
    assert kinds(f"k {base64.b64encode(KEY[:-1] + b'xx').decode()}") == []
    assert kinds(f"k {KEY.hex()}") == ["hex", "hex_key"]
    assert kinds("-----BEGIN PRIVATE KEY-----\n" + base64.b64encode(KEY).decode() + "\n-----END PRIVATE KEY-----")[0] == "pem_key"
    assert kinds("PassWord : 'abcdef' secret=abc AKIA123 AKIA" + "Z" * 16) == ["assign", "access"]
    assert secrets.find_secrets(None) == [] and secrets.find_secrets("") == []


def test_secrets_in_every_common_form():
    kinds = lambda t: [secrets.KINDS[k] for _, k, _ in secrets.find_secrets(t) if k > 2]
    b64 = lambda x: base64.b64encode(x).decode()
    wrap = lambda x, end, n=64: end.join(x[k : k + n] for k in range(0, len(x), n))
    pem = "-----BEGIN PRIVATE KEY-----\n" + wrap(b64(KEY), "\n") + "\n-----END PRIVATE KEY-----\n"
    for before in ("PRIVATE_KEY=", "der=", 'k: "', "a/", "a+", "a_", "a-", "word\n", "\\n"):
        assert kinds(f"{before}{b64(KEY)}") == ["encoded_key"], before
        assert kinds(f"{before}{b64(KEY[:-1] + b'xx')}") == [], before
    assert kinds(json.dumps({"private_key": pem})) == ["pem_key"] and kinds(json.dumps(json.dumps({"private_key": pem}))) == ["pem_key"]
    assert kinds(f"client-key-data: {b64(pem.encode())}") == ["encoded_key"] and kinds(f"x: {b64(b'[1]' + pem.encode())} y") == ["encoded_key"]
    assert kinds(f"x: {pem.encode().hex()}") == ["hex_key"] and kinds(f"x: {b64(b64(KEY).encode())}") == ["encoded_key"]
    for end in ("\n", "\r\n", "\\n", "\n    ", "\\\n"):
        text = f"see\n{wrap(b64(KEY), end)}\nand more"
        assert kinds(text) == ["encoded_key"] and kinds(f"see {wrap(KEY.hex(), end)} more") == ["hex_key"], end
        (a, _, b), = [x for x in secrets.find_secrets(text) if x[1] == 5]
        assert text[a:b].startswith("MI") and text[b:].lstrip() == "and more"
    assert kinds("prose\nwith short\nlines " * 400 + "M" * 5000) == []


def test_secret_scan_digest_and_redaction(spark):
    out = {}
    for r in secrets.digest(secrets.scan_secrets(fx.table(spark))).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, out.values())) == len(fx.rows())
    text = next(t for i, t, *_ in fx.rows() if i == 142)
    a = text.index("token")
    span = f"assign:{a}:{a + 9 + 48},hex:{a + 9}:{a + 9 + 48}"
    assert out[142][0]["spans"] == span and out[142][0]["base_sha256"] == hashlib.sha256(span.encode()).hexdigest()
    assert out[130][0]["base_sha256"] == hashlib.sha256(b"").hexdigest() and out[130][0]["n_hex"] == 0
    clean = {(r["doc_id"], r["n_chars"]): r["text"] for r in secrets.redact(fx.table(spark)).collect()}
    assert next(v for (i, _), v in clean.items() if i == 142) == text[:a] + "<assign>" + text[a + 9 + 48 :]
    assert secrets.scan_secrets(fx.empty(spark)).count() == 0 and secrets.redact(fx.empty(spark)).count() == 0


def brute_components(data):
    sets = []
    for _, t, *_ in data:
        w = WORD.findall(lower(t))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    up = list(range(len(data)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(data):
        least.setdefault(find(i), []).append(d)
    low = {r: min((d for d in ds if d is not None), default=None) for r, ds in least.items()}
    return Counter((d, len(sets[i]), low[find(i)]) for i, (d, *_) in enumerate(data))


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_join_against_all_pairs(spark, monkeypatch, small):
    if small:  # tiny tiles take the ways of very large groups
        monkeypatch.setattr(jaccard, "SMALL_TILE", 2)
        monkeypatch.setattr(jaccard, "TILE", 3)
        monkeypatch.setattr(jaccard, "MOST_TOGETHER", 3)
    got = Counter(tuple(r) for r in jaccard.join_near_duplicates(fx.table(spark)).collect())
    assert got == brute_components(fx.rows())


def test_jaccard_reads_no_sets_of_unlike_texts_with_a_common_passage(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_TILE", 2)
    monkeypatch.setattr(jaccard, "LEAST_COMMON", 1000)  # as in a large table, where the passage is no more common than most buckets
    read, plain = [], jaccard.compare_units
    monkeypatch.setattr(jaccard, "compare_units", lambda seats, sets: read.append(seats.count()) or plain(seats, sets))
    rng, passage = random.Random(8), " ".join(f"r{k}" for k in range(24))  # some of it in every prefix
    prose = lambda n: " ".join(f"w{rng.getrandbits(40)}" for _ in range(n))
    unlike = [f"{prose(40)} {passage} {prose(40 + 23 * (k % 2))}" for k in range(80)]  # 100 or 123 shingles
    data = [(k, x, None, "s", len(x), "k", "n", "s", "t", "x") for k, x in enumerate(unlike + [unlike[3] + " more words", "and " + unlike[3]])]
    got = Counter(tuple(r) for r in jaccard.join_near_duplicates(fx.table(spark, data)).collect())
    assert got == brute_components(data)
    assert sum(read) < 20  # every text of a tile met another in it by size alone


def test_jaccard_keeps_one_of_each(spark):
    assert jaccard.join_near_duplicates(fx.empty(spark)).count() == 0
    kept = Counter(r["doc_id"] for r in jaccard.keep_one(fx.table(spark)).select("doc_id").collect())
    alone = {d for (d, _, c), _ in brute_components(fx.rows()).items() if d is not None and d == c}
    assert {d for d in kept if d is not None} == alone | {130, 131, 132} and kept[None] == 2 and max(v for k, v in kept.items() if k is not None) == 1


def test_jaccard_keeps_unlike_texts_of_one_id_and_nothing_of_none(spark):
    one, two = " ".join(f"w{k}" for k in range(30)), " ".join(f"v{k}" for k in range(30))
    data = [(5, one), (5, two), (5, one), (6, one), (7, two), (5, None), (5, ""), (None, two), (8, "alone here")]
    docs = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, Node string")
    kept = Counter((r["doc_id"], r["text"]) for r in jaccard.keep_one(docs).collect())
    assert kept == Counter([(5, one), (5, two), (5, None), (5, ""), (None, two), (8, "alone here")])
    assert jaccard.keep_one(docs.where("false")).count() == 0 and jaccard.keep_one(docs.where("false")).columns == docs.columns


def brute_bins(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(5)
    for capacity in (7, 16, 64, 100):
        for _ in range(40):
            lengths = rng.integers(1, capacity + 1, rng.integers(1, 120)).tolist()
            rows, bins = packing.plan_bins(Counter(lengths), capacity)
            assert bins == brute_bins(lengths, capacity)
            filled, placed = Counter(), Counter()
            for n, rank, count, first, per, offset in rows:
                for k in range(count):
                    filled[first + k // per] += n
                    placed[n, rank + k] += 1
            assert max(filled.values()) <= capacity and max(placed.values()) == 1 and len(placed) == len(lengths)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(fx.table(spark), tokenizer_path(), keep_ids=True).toPandas()
    want = Counter()
    for d, t, *_ in fx.rows():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), packing.CAPACITY):
            part = np.array(ids[k : k + packing.CAPACITY], "<u4")
            want[d, k // packing.CAPACITY, k, len(part), zlib.crc32(part.tobytes())] += 1
    have = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples())
    assert have == want
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() <= packing.CAPACITY
    assert got["sequence_id"].nunique() == brute_bins(got["length"].tolist(), packing.CAPACITY)
    assert packing.pack(fx.empty(spark), tokenizer_path()).count() == 0


def test_rules_against_plain_counts(spark):
    trusted = spark.createDataFrame([(k,) for k in range(0, 40, 2)] + [(None,)], "doc_id long")
    out = {}
    for r in rules.judge_quality(fx.table(spark), trusted).collect():
        out.setdefault((r["doc_id"], r["n_words"], r["word_chars"]), r)
    for d, t, *_ in fx.rows():
        w = WORD.findall(t or "")
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = out[d, len(w), sum(map(len, w))]
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        assert (r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), failed)
        assert r["kept"] == (not failed and r["ratio"] >= r["cut"])
    assert not out[140, 400, 1200]["kept"]
    assert rules.judge_quality(fx.empty(spark), trusted).count() == 0
    none = spark.createDataFrame([], "doc_id long")
    assert all(r["ratio"] == 0 for r in rules.judge_quality(fx.table(spark), none).collect())


@pytest.mark.parametrize("most", [2_000_000, 3])
def test_rules_cut_tells_held_out_trusted_from_others(spark, monkeypatch, most):
    monkeypatch.setattr(rules, "MOST_IDS", most)
    rng = random.Random(5)
    plain, odd = ([f"{c}{k}" for k in range(150)] for c in "pq")
    text = lambda share: " ".join(rng.choice(odd if rng.random() < share else plain) for _ in range(120))
    data = [(k, text(0.1)) for k in range(200)] + [(k, text(0.3)) for k in range(200, 400)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    trusted, others = docs.where("doc_id < 160").select("doc_id"), docs.where("doc_id between 200 and 360").select("doc_id")
    kept = {r["doc_id"] for r in rules.judge_quality(docs, trusted, others).collect() if r["kept"]}
    assert sum(k in kept for k in range(160, 200)) >= 34 and sum(k in kept for k in range(361, 400)) <= 4


def test_rules_join_beyond_the_broadcast(spark, monkeypatch):
    trusted = spark.createDataFrame([(k,) for k in range(20)], "doc_id long")
    one = {(r["doc_id"], r["n_words"]): r["ratio"] for r in rules.judge_quality(fx.table(spark), trusted).collect()}
    monkeypatch.setattr(rules, "MOST_IDS", 3)
    two = {(r["doc_id"], r["n_words"]): r["ratio"] for r in rules.judge_quality(fx.table(spark), trusted).collect()}
    assert one == pytest.approx(two)


def test_additive_model_learns_and_scores_all(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction that no single feature shows
    model = gam.fit(x, y)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(140, 0, 0), (141, 0, 0), (None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = gam.classify(fx.table(spark), labels).collect()
    assert len(got) == len(fx.rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert gam.classify(fx.empty(spark), labels).count() == 0
    assert len({r["score"] for r in gam.classify(fx.table(spark), labels.limit(0)).collect()}) == 1


def test_smith_waterman_against_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, start, end = decontam.smith_waterman(a, b)
        assert score == h.max() and 0 <= start <= end <= len(b)


def test_decontamination_finds_edited_copies(spark, monkeypatch):
    item = "Seven quiet people carried an unusual violet lantern across the frozen harbour while nobody in town could explain where its peculiar humming came from before sunrise."
    words = item.split()
    edited = " ".join(w for k, w in enumerate(words) if k % 9 != 4)
    swapped = " ".join("word" if k % 7 == 3 else w for k, w in enumerate(words))
    data = [(200, f"before {item} after"), (201, f"x y {edited} z"), (202, f"{swapped}"), (203, " ".join(words[:5])), (204, item.upper().replace(",", "")), (205, "harbour town people the of in")]
    docs = fx.table(spark, fx.rows() + [(i, t, "en", "s", len(t), *["c"] * 5) for i, t in data])
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short item words"), (None, item)], "item_id long, text string")
    want = {(200, 1), (201, 1), (202, 1), (204, 1)}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_copies(docs, bench).collect()}
    assert got == want
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 10)  # the benchmark in several blocks
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_copies(docs, bench).collect()} == want
    left = Counter(r["doc_id"] for r in decontam.drop_copies(docs, bench).collect())
    assert left == Counter(d for d, *_ in fx.rows()) + Counter([203, 205])
    assert decontam.find_copies(fx.empty(spark), bench).count() == 0 and decontam.find_copies(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [9, 1000])
def test_an_edited_copy_in_many_documents_is_found(spark, copies):
    words = [f"w{k}" for k in range(40)]
    edited = " ".join("other" if k % 10 in (2, 5) else w for k, w in enumerate(words))
    data = [(k, f"d{k} {edited} e{k}") for k in range(copies)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = decontam.find_copies(spark.createDataFrame(data, "doc_id long, text string"), bench).collect()
    assert {r["doc_id"] for r in got} == set(range(copies)) and all(r["ratio"] > 0.5 for r in got)


def test_the_bound_on_the_score_loses_no_alignment():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(-1, 9, rng.integers(1, 30))
        assert decontam.most_score(np.unique(a), b) >= decontam.smith_waterman(a, b)[0]


def test_language_model_counts_and_probabilities(spark, monkeypatch):
    monkeypatch.setattr(hpylm, "BLOCK_TOKENS", 3000)
    monkeypatch.setattr(hpylm, "BUCKET_PAIRS", 900)
    data = fx.rows()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    tokens = [(d, [*WORD.findall(lower(t)), None]) for d, t, *_ in data]
    c = Counter(w for d, ws in tokens if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if d is None else d, held(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in tokens)
    got = hpylm.score_texts(fx.table(spark)).toPandas()
    have = sorted((-1 if r.doc_id is None or r.doc_id != r.doc_id else int(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.fillna({"doc_id": -1}).itertuples())
    assert have == want
    out = got[got["held_out"]]
    assert out["score"].sum() > out["base_score"].sum() and (got["score"] < 0).all()
    assert hpylm.score_texts(fx.empty(spark)).count() == 0


def exact_tables(c, first, growth, d):
    """The mean number of tables from the full distribution over t, by the recursion of the Stirling numbers."""
    log = np.full(c + 2, -np.inf)
    log[1] = 0.0
    for n in range(1, c):
        t = np.arange(1, c + 1)
        log[1:-1] = np.logaddexp(log[0:-2], log[1:-1] + np.log(np.maximum(n - t * d, 1e-300)))
        log[n + 2 :] = -np.inf
    t = np.arange(1, c + 1)
    weight = log[1:-1] + np.concatenate([[0.0], np.cumsum(np.log(first + growth * t[:-1]))])
    p = np.exp(weight - weight.max())
    return float((p * t).sum() / p.sum())


@pytest.mark.parametrize(("c", "first", "growth", "d"), [(2, 0.3, 0, 0.5), (5, 2.0, 0.1, 0.7), (40, 0.2, 0, 0.6), (100, 0.2, 0, 0.6), (1000, 1.0, 0, 0.6), (1000, 30.0, 0.4, 0.8), (3000, 0.5, 0.3, 0.5), (3000, 120.0, 0, 0.7), (6000, 3.0, 0, 0.9)])
def test_tables_are_drawn_from_their_exact_distribution(c, first, growth, d):
    n = 4000
    key = np.random.default_rng(c).integers(0, 2**64, n, dtype=np.uint64)
    t = hpylm.draw_tables(np.full(n, c), np.full(n, first), np.full(n, float(growth)), d, key)
    assert t.min() >= 1 and t.max() <= c and t.mean() == pytest.approx(exact_tables(c, first, growth, d), rel=0.05)


def test_scores_depend_on_neither_blocks_nor_buckets_nor_layout(spark, monkeypatch):
    found = []
    for tokens, pairs, partitions in ((3000, 900, 3), (10**7, 10**7, 2), (500, 300, 5)):
        monkeypatch.setattr(hpylm, "BLOCK_TOKENS", tokens)
        monkeypatch.setattr(hpylm, "BUCKET_PAIRS", pairs)
        got = hpylm.score_texts(fx.table(spark, partitions=partitions)).toPandas()
        found.append(sorted((r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.itertuples()))
    assert found[0] == found[1] == found[2]


def test_a_block_of_full_size_takes_bounded_memory():
    import tracemalloc

    rng, n = np.random.default_rng(4), hpylm.BLOCK_TOKENS
    sizes = np.full(n // 500, 500, np.int64)
    codes, vocabulary = (rng.random(len(sizes) * 500) ** 4 * 400_000).astype(np.int32), np.sort(hpylm.mix(np.arange(400_000, dtype=np.uint64)))
    held = rng.random(len(sizes)) < 0.2
    data = hpylm.packed(np.arange(len(sizes)), np.ones(len(sizes), bool), held, sizes, codes, vocabulary)
    hot = hpylm.Hot(vocabulary[:3], np.array([4, 3, 2], np.uint64))
    tracemalloc.start()
    try:
        own = hpylm.Block(data, hot, 10)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 48 * n  # bytes a token
    keys, at, times = np.unique(hpylm.pair_keys(sizes, codes, len(vocabulary)), return_inverse=True, return_counts=True)
    assert (own.u * np.int64(len(vocabulary) + 1) + own.w == keys).all() and (own.at == at).all()
    kept = ~np.repeat(held, sizes)
    assert own.counts().sum() == kept.sum() and (own.counts() <= times).all()


def test_gibbs_samples_the_right_number_of_tables():
    """Three customers of one dish, new tables of weight alpha: the chain's mean number of tables against the exact one."""
    alpha, d, n = 1.5, 0.4, 4000
    weight = {1: (1 - d) * (2 - d), 2: 3 * alpha * (1 - d), 3: alpha * alpha}  # partitions of three customers, first table's factor left out
    exact = sum(k * w for k, w in weight.items()) / sum(weight.values())
    mean, _ = hpylm.sample_tables(np.full(n, 3), lambda t: np.full(n, alpha), d, 3, rounds=60, burn=20)
    assert mean.mean() == pytest.approx(exact, abs=0.02)

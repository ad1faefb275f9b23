"""Language-model scoring: a hierarchical Pitman-Yor model of word pairs.

Each word's followers sit in a restaurant of their own; all these share one parent, the restaurant of single words, whose
base is uniform over the known words and one unknown. What the model needs of a seating is the number of tables of each dish.
A Gibbs step draws that of a whole dish at once, all its customers reseated, from its exact conditional distribution: with c
customers, P(t) is in proportion to the generalised Stirling number of c and t times the weights of the t tables opened.
Contexts and parent take turns for ROUNDS rounds; tables of the contexts are customers of the parent. The predictive
probability is the mean over the joint samples of the rounds after BURN.

All counts are over all training documents. The work goes by blocks of documents and by buckets of hashed contexts and
words: blocks send their distinct pairs to the context buckets, these and the word buckets (the parent) exchange tables, and
each block gets back the probabilities of its pairs. Restaurants of very common contexts are dealt over several buckets,
their totals added up each round. Within a round all dishes of a restaurant move against its total of the round before.
Draws are keyed by the hashes of the words, so that scores depend neither on blocks and buckets nor on the input's layout.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.shared import Codes, discard, hash_words, mix, release, slices, stash, trim, words_of

#: Concentrations of the context restaurants and of the parent; the parent's discount. The context discount follows the counts.
STRENGTH, ROOT_STRENGTH, ROOT_DISCOUNT = 1.0, 10.0, 0.5
ROUNDS, BURN = 4, 1
#: Customers and tables up to which ratios of Stirling numbers are tabled; beyond, their asymptotic forms are used.
MOST_CUSTOMERS, MOST_TABLES = 2048, 48
BLOCK_TOKENS, BUCKET_PAIRS = 2_500_000, 2_500_000
#: Places of the bitmap by which a block's distinct pairs are estimated.
COUNTED = 1 << 22
#: Rows that are made into Python strings at once, and pairs that are dealt to buckets at once; they bound a worker's memory.
ROWS_AT_ONCE, PAIRS_AT_ONCE = 512, 1 << 18
#: Hashes of a text's end and of what stands before its first word; the latter sorts last.
END, START = 0xE5D, 0xFFFFFFFFFFFFFFFF
FOLDS, HELD = 7, 2


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: byte planes apart (sorted hashes and small numbers then compress well), and Zstandard."""
    planes = [(a.dtype.str, np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes, protocol=5))


def unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    out = []
    for kind, planes in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        wide = np.dtype(kind)
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(wide.itemsize, -1).T).view(wide).ravel())
    return tuple(out)


def shortened(p: np.ndarray) -> np.ndarray:
    """Probabilities as 32-bit floats with 15 bits of mantissa kept, so that a byte plane is empty: off by less than 1 in 50,000."""
    return ((p.astype(np.float32).view(np.uint32) + np.uint32(0x80)) & np.uint32(0xFFFFFF00)).view(np.float32)


def held_out(key):
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(FOLDS)) == HELD, F.lit(False))


class Ratios:
    """S(c, t) / S(c, t - 1) for generalised Stirling numbers S of discount d, 2 <= t <= c."""

    def __init__(self, d: float):
        self.d, t = d, np.arange(2, MOST_TABLES + 1)
        self.table = np.zeros((MOST_CUSTOMERS + 1, MOST_TABLES + 1))
        row = np.zeros(len(t))
        for c in range(1, MOST_CUSTOMERS):
            # S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t); what S(c, t) isn't there is 0.
            before = np.concatenate([[0.0], 1 / np.where(row[:-1] > 0, row[:-1], 1.0)])
            row = np.where(t <= c + 1, (1 + (c - t * d) * row) / np.maximum(before + c - (t - 1) * d, 1e-300), 0.0)
            self.table[c + 1, 2:] = row
        # Many tables: S(c, t) is c! / t! times a coefficient of (f(x))^t, f(x) = (1 - (1 - x)^d) / d, taken at its saddle point.
        y = np.concatenate([1 - np.geomspace(1e-9, 0.5, 2000), np.geomspace(0.5, 1e-300, 8000)[1:]])
        f = -np.expm1(d * np.log(y)) / d
        self.log_c_t, self.log_f = np.log((1 - y) * y ** (d - 1) / f), np.log(f)

    def __call__(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        few = np.minimum(t, MOST_TABLES)
        out = self.table[np.minimum(c, MOST_CUSTOMERS), few]
        long = np.flatnonzero((c > MOST_CUSTOMERS) & (t <= MOST_TABLES))
        if len(long):  # the ratio tends to 1 / (d (t - 1)) as c^-d tends to 0
            limit = self.d * (few[long] - 1)
            out[long] = np.exp(np.log(out[long] * limit) * (c[long] / MOST_CUSTOMERS) ** -self.d) / limit
        wide = np.flatnonzero(t > MOST_TABLES)
        if len(wide):
            out[wide] = np.exp(np.interp(np.log(c[wide] / (t[wide] - 0.5)), self.log_c_t, self.log_f)) / t[wide]
        return out


_RATIOS: dict[float, Ratios] = {}


def ratios(d: float) -> Ratios:
    if d not in _RATIOS:
        _RATIOS.clear() if len(_RATIOS) > 4 else None
        _RATIOS[d] = Ratios(d)
    return _RATIOS[d]


def draw_tables(c: np.ndarray, first: np.ndarray, growth: np.ndarray, d: float, key: np.ndarray) -> np.ndarray:
    """The number of tables of each dish, drawn from its conditional distribution given all other dishes.

    c: customers; opening a table where i are open weighs first + growth * i; key: a random 64-bit number a dish, which alone
    decides its draw. The sum over t starts at most 12 deviations below the mode and ends where nothing is left to add.
    """
    out = np.minimum(c, 1).astype(np.int64)
    ratio = ratios(d)
    at = np.flatnonzero(c >= 2)
    if not len(at):
        return out
    n, a, g, key = c[at].astype(np.int64), first[at], growth[at], key[at]
    low = np.ones(len(at), np.int64)
    rising = np.flatnonzero((a + g) * ratio(n, np.full(len(at), 2)) > 1)
    if len(rising):  # the mode, by bisection: weights rise to it and then fall
        lo, hi = np.ones(len(rising), np.int64), n[rising].copy()
        while (hi - lo > 1).any():
            mid = (lo + hi) // 2
            up = (a[rising] + g[rising] * (mid - 1)) * ratio(n[rising], np.maximum(mid, 2)) > 1
            lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
        low[rising] = np.maximum(1, (lo - 12 * np.sqrt(lo) - 12).astype(np.int64))
    t, weight, total, taken = low.copy(), np.ones(len(at)), np.ones(len(at)), low.copy()
    left = np.flatnonzero(t < n)
    while len(left):
        opened = t[left]
        step = (a[left] + g[left] * opened) * ratio(n[left], opened + 1)
        t[left] = opened + 1
        weight[left] *= step
        total[left] += weight[left]
        with np.errstate(over="ignore"):
            chance = (mix(key[left] + mix((opened + 1).view(np.uint64))) >> np.uint64(11)) * 2.0**-53
        won = left[chance * total[left] < weight[left]]
        taken[won] = t[won]
        left = left[(t[left] < n[left]) & ((step > 1) | (weight[left] > 1e-9 * total[left]))]
    out[at] = taken
    return out


def sample_tables(c: np.ndarray, alpha_of, d: float, seed: int, rounds: int = ROUNDS, burn: int = BURN) -> tuple[np.ndarray, np.ndarray]:
    """Mean and last number of tables of each dish; alpha_of(tables) gives the weights of new tables for a round."""
    tables, total = np.minimum(c, 1).astype(np.int64), np.zeros(len(c))
    for k in range(rounds):
        key = mix(np.arange(len(c), dtype=np.uint64) + np.uint64(seed * 1_000_003 + k << 32))
        tables = draw_tables(c, alpha_of(tables), np.zeros(len(c)), d, key)
        if k >= burn:
            total += tables
    return total / max(1, rounds - burn), tables


BLOCK = "block long, data binary, n_pairs long"


def block_table(docs: DataFrame) -> DataFrame:
    """Blocks of documents as numbers: ids, whether they have one, whether held out, tokens of each, the tokens and the
    vocabulary's hashes. A table, so that blocks stay the same from now on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k, words = TaskContext.get().partitionId(), 0, Codes({None: 0})
        held, parts, tokens = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal k, held, parts, tokens, words
            ids, flags, sizes, codes = (np.concatenate([p[i] for p in parts]) for i in range(4))
            names = np.concatenate([np.array([END], np.uint64), hash_words([w for w in words if w is not None])])
            valid, held, parts, words = np.concatenate(held), [], [], Codes({None: 0})
            vocabulary, rank = np.unique(names, return_inverse=True)
            codes = rank.astype(np.int32)[codes]
            del names, rank
            data = packed(ids, valid, flags, sizes, codes, vocabulary)
            seen, keys = np.zeros(COUNTED, bool), pair_keys(sizes, codes, len(vocabulary)).view(np.uint64)
            for a in range(0, len(keys), PAIRS_AT_ONCE):
                seen[(mix(keys[a : a + PAIRS_AT_ONCE]) & np.uint64(COUNTED - 1)).astype(np.int64)] = True
            pairs = -COUNTED * np.log(max(1 / COUNTED, 1 - seen.mean()))  # linear counting: the number only sets how many buckets there are
            out = pa.RecordBatch.from_arrays([pa.array([part << 32 | k]), pa.array([data], pa.binary()), pa.array([int(pairs)])], names=["block", "data", "n_pairs"])
            k, tokens = k + 1, 0
            del ids, valid, flags, sizes, codes, vocabulary, seen, keys, data
            trim()
            return out

        for batch in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                lists = [words_of(t) for t in texts[a:b]]
                sizes = np.fromiter((len(x) + 1 for x in lists), np.int64, b - a)
                codes = np.zeros(int(sizes.sum()), np.int64)
                inner = np.ones(len(codes), bool)
                inner[np.cumsum(sizes) - 1] = False
                codes[inner] = words.of([w for x in lists for w in x])
                ids = batch.column(0).slice(a, b - a)
                held.append(np.asarray(ids.is_valid()))
                parts.append((np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(batch.column(2).slice(a, b - a)), sizes, codes.astype(np.int32)))
                tokens += len(codes)
                del lists, codes, inner
                if tokens >= BLOCK_TOKENS:
                    yield flush()
        if parts:
            yield flush()

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held"))
    return stash(picked.mapInArrow(work, BLOCK), "lm-blocks")


def pair_keys(sizes: np.ndarray, codes: np.ndarray, v: int) -> np.ndarray:
    """Each token's (word before, word) as one number; before a text's first word stands v."""
    before = np.empty(len(codes), np.int64)
    before[1:] = codes[:-1]
    before[np.cumsum(sizes) - sizes] = v
    before *= v + 1
    before += codes
    return before


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys, and the place of each key among them (int32): np.unique in about half the memory."""
    order = np.argsort(keys)
    keys = keys[order]
    fresh = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    keys, rank = keys[fresh], np.cumsum(fresh, dtype=np.int32)
    del fresh
    rank -= 1
    at = np.empty(len(rank), np.int32)
    at[order] = rank
    return keys, at


@dataclass(frozen=True)
class Hot:
    """Very common contexts: sorted hashes, and the parts into which each is dealt."""

    words: np.ndarray
    parts: np.ndarray

    def parts_of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.ones(len(words), np.uint64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.parts[at], np.uint64(1))


class Block:
    """A block's distinct pairs in a fixed order, dealt to buckets."""

    def __init__(self, data: bytes, hot: Hot, buckets: int):
        self.ids, self.valid, self.held, self.sizes, self.codes, self.vocabulary = unpacked(data)
        v = len(self.vocabulary)
        keys, self.at = distinct(pair_keys(self.sizes, self.codes, v))
        self.n_pairs = len(keys)
        self.u, self.w, self.bucket = np.empty(len(keys), np.int32), np.empty(len(keys), np.int32), np.empty(len(keys), np.int32)
        self.names = np.append(self.vocabulary, np.uint64(START))
        for a in range(0, len(keys), PAIRS_AT_ONCE):
            k = slice(a, a + PAIRS_AT_ONCE)
            self.u[k], self.w[k] = np.divmod(keys[k], v + 1)
            hu, hw = self.names[self.u[k]], self.vocabulary[self.w[k]]
            with np.errstate(over="ignore"):
                spread = mix(hu + mix(hw) % hot.parts_of(hu))
            self.bucket[k] = spread % np.uint64(buckets)
        self.word_bucket = (mix(self.vocabulary ^ np.uint64(0xABCDEF)) % np.uint64(buckets)).astype(np.int64)

    def counts(self) -> np.ndarray:
        """How often each pair occurs in training texts."""
        return np.bincount(self.at[~np.repeat(self.held, self.sizes)], minlength=self.n_pairs).astype(np.int32)


def common_contexts(blocks: DataFrame, buckets: int) -> Hot:
    """The words that are more than a 4 * buckets-th of the training tokens, at most 4 * buckets, each in parts of about that."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                _, _, held, sizes, codes, vocabulary = unpacked(data)
                count = np.bincount(codes, ~np.repeat(held, sizes), len(vocabulary)).astype(np.int64)
                total, starts = int(count.sum()), int((~held).sum())
                top = np.flatnonzero(count > total / (8 * buckets))
                word, n = np.append(vocabulary[top], np.uint64(START)).view(np.int64), np.append(count[top], starts)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(word, -1)), pa.array(np.append(n, total)), pa.array([False] * len(n) + [True])], names=["word", "n", "all"])

    counts = blocks.select("data").mapInArrow(work, "word long, n long, all boolean").groupBy("word", "all").agg(F.sum("n").alias("n"))
    total = (counts.where("all").first() or {"n": 0})["n"]
    rows = counts.where(~F.col("all") & (F.col("n") > total / (4 * buckets))).toPandas()
    words, n = rows["word"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(words)
    return Hot(words[order], (1 + 4 * buckets * n[order] // max(1, total)).astype(np.uint64))


MESSAGE = "to long, kind string, sender long, data binary, a long, b long, c long"
_NAMES = ["to", "kind", "sender", "data", "a", "b", "c"]


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    types = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_NAMES)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES)


def _by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    for k, own in enumerate(np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))):
        if len(own):
            yield k, own


def score_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) for every row of docs(doc_id, text).

    A null or empty text is its end alone. Repeated rows are scored, and counted, each. A null doc_id is not held out. A very
    long text is scored whole, within one block. Other columns are not looked at. An empty table gives an empty result; without
    training documents every token is unknown and has probability 1. perplexity is that of the text: 10 ^ (-score / n_tokens).
    """
    spark = docs.sparkSession
    blocks = block_table(docs)
    n_pairs = blocks.agg(F.sum("n_pairs")).first()[0] or 0
    nb = max(1, -(-int(n_pairs) // BUCKET_PAIRS))
    hot = common_contexts(blocks, nb)

    # Blocks send their pairs to the context buckets.
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Block(data, hot, nb)
                count = own.counts()
                own.at = own.codes = None
                for k, at in _by_bucket(own.bucket, nb):
                    us, u = np.unique(own.u[at], return_inverse=True)
                    ws, w = np.unique(own.w[at], return_inverse=True)
                    yield _messages([(k, "pairs", block, packed(own.names[us], own.names[ws], np.bincount(u).astype(np.int32), w.astype(np.int32), count[at]), None, None, None)])
                del own, count
                trim()

    # A context bucket merges them: its state, and for each block the places of its pairs.
    def merge(part: pd.DataFrame) -> pd.DataFrame:
        to = int(part["to"].iloc[0])
        part = part.sort_values("sender")
        got = [unpacked(x) for x in part["data"]]
        us, ws = np.unique(np.concatenate([g[0] for g in got])), np.unique(np.concatenate([g[1] for g in got]))
        keys = np.concatenate([np.searchsorted(us, np.repeat(g[0], g[2])) * np.int64(len(ws)) + np.searchsorted(ws, g[1])[g[3]] for g in got])
        counts = np.concatenate([g[4] for g in got])
        sizes = [len(g[3]) for g in got]
        del got
        pairs, at = distinct(keys)
        del keys
        c = np.bincount(at, counts, len(pairs)).astype(np.int64)
        u, w = pairs // len(ws), pairs % len(ws)
        rows = [(to, "state", -1, packed(us, ws, np.bincount(u, minlength=len(us)).astype(np.int32), w.astype(np.int32), c.astype(np.int32)), int((c == 1).sum()), int((c == 2).sum()), 0)]
        for sender, places in zip(part["sender"], np.split(at, np.cumsum(sizes)[:-1]), strict=True):
            rows.append((to, "places", int(sender), packed(np.diff(places, prepend=np.int32(0))), 0, 0, 0))  # ascending, as both sides sort by hash
        del pairs, at, counts, c, u, w
        trim()
        return _frame(rows)

    merged = stash(blocks.select("block", "data").mapInArrow(send, MESSAGE).groupBy("to").applyInPandas(merge, MESSAGE), "lm-pairs")
    release(spark)
    state = merged.where("kind = 'state'")
    ones, twos = (int(x or 0) for x in state.agg(F.sum("a"), F.sum("b")).first())
    d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.75

    def word_bucket(h: np.ndarray) -> np.ndarray:
        return (mix(h ^ np.uint64(0xABCDEF)) % np.uint64(nb)).astype(np.int64)

    def customers(to: int, us, ws, u, w, t, c, counted: bool = False) -> Iterator[tuple]:
        """What a context bucket tells the word buckets: tables by word (and counts, once), and both of its common contexts."""
        tables, counts = np.bincount(w, t, len(ws)).astype(np.int64), np.bincount(w, c, len(ws)).astype(np.int64)
        for k, at in _by_bucket(word_bucket(ws), nb):
            yield (k, "words", to, packed(ws[at], tables[at], counts[at] if counted else counts[:0]), None, None, None)
        common = np.flatnonzero(np.isin(us, hot.words))
        if len(common):
            tables, counts = np.bincount(u, t, len(us)).astype(np.int64)[common], np.bincount(u, c, len(us)).astype(np.int64)[common]
            for k, at in _by_bucket(word_bucket(us[common]), nb):
                yield (k, "common", to, packed(us[common][at], tables[at], counts[at]), None, None, None)

    # The first seating: a table a pair.
    def first_customers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for to, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                us, ws, followers, w, c = unpacked(data)
                yield _messages(list(customers(to, us, ws, np.repeat(np.arange(len(us)), followers), w, np.minimum(c, 1), c, True)))

    def gather(part: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        part = part[part["kind"] == kind].sort_values("sender")
        got = [unpacked(x) for x in part["data"]]
        words = np.unique(np.concatenate([np.zeros(0, np.uint64), *(g[0] for g in got)]))
        at = [np.searchsorted(words, g[0]) for g in got]
        flat = np.concatenate([np.zeros(0, np.int64), *at])
        sums = lambda i: np.bincount(flat, np.concatenate([np.zeros(0, np.int64), *(g[i] for g in got)]), len(words)).astype(np.int64)
        t, n = sums(1), sums(2) if all(len(g[2]) == len(g[0]) for g in got) else np.zeros(len(words), np.int64)
        return words, t, n, list(zip(part["sender"], at, strict=True))

    def count_words(part: pd.DataFrame) -> pd.DataFrame:
        _, _, n, _ = gather(part, "words")
        return pd.DataFrame({"tokens": [int(n.sum())], "words": [int((n > 0).sum())]})

    asked = stash(state.select("to", "data").mapInArrow(first_customers, MESSAGE), "lm-customers")
    totals = asked.groupBy("to").applyInPandas(count_words, "tokens long, words long").agg(F.sum("tokens"), F.sum("words")).first()
    n_train, v = int(totals[0] or 0), int(totals[1] or 0)

    # Blocks ask the word buckets for the counts of their words.
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vocabulary = unpacked(data)[5]
                for k, at in _by_bucket(word_bucket(vocabulary), nb):
                    yield _messages([(k, "ask", block, packed(vocabulary[at]), None, None, None)])

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        to = int(part["to"].iloc[0])
        words, _, n, _ = gather(part, "words")
        rows, asked = [], part["kind"] == "ask"
        for sender, data in zip(part["sender"][asked], part["data"][asked], strict=True):
            at = np.searchsorted(words, unpacked(data)[0])  # every word of a block is in some pair
            rows.append((int(sender), "known", to, packed(n[at]), 0, 0, 0))
        return _frame(rows)

    requests = blocks.select("block", "data").mapInArrow(ask, MESSAGE)
    known = stash(asked.where("kind = 'words'").unionByName(requests).groupBy("to").applyInPandas(answer, MESSAGE), "lm-known")
    release(spark)

    def parent_step(turn: int, root_tables: int):
        """The parent's Gibbs step: each word's customers reseated against all other tables of the round before."""

        def step(part: pd.DataFrame) -> pd.DataFrame:
            to = int(part["to"].iloc[0])
            words, k, _, senders = gather(part, "words")
            before = np.minimum(k, 1)
            for data in part["data"][part["kind"] == "own"]:
                before = unpacked(data)[0]
            first = np.maximum(ROOT_STRENGTH + ROOT_DISCOUNT * (root_tables - before), 1e-9) / (v + 1)
            with np.errstate(over="ignore"):
                key = mix(words + np.uint64(2 * turn + 1) * np.uint64(0x9E3779B97F4A7C15))
            t = draw_tables(k, first, np.full(len(k), ROOT_DISCOUNT / (v + 1)), ROOT_DISCOUNT, key)
            rows = [(-1, "root", to, None, int(k.sum()), int(t.sum()), 0), (to, "own", to, packed(t), 0, 0, 0)]
            rows += [(int(s), "parent", to, packed(k[at].astype(np.int32 if k.max(initial=0) < 2**31 else np.int64), t[at].astype(np.int32)), 0, 0, 0) for s, at in senders]
            common, tables, counts, senders = gather(part, "common")
            rows += [(int(s), "totals", to, packed(common[at], tables[at], counts[at]), 0, 0, 0) for s, at in senders]
            return _frame(rows)

        return step

    class Restaurants:
        """A context bucket's restaurants under one joint sample: tables of the dishes (of two customers or more), the parent's
        probabilities, and tables and customers of each context over all buckets."""

        def __init__(self, part: pd.DataFrame, turn: int, customers: int, root_tables: int):
            kinds = part["kind"]
            self.us, self.ws, followers, self.w, c = unpacked(part["data"][kinds == "state"].iloc[0])
            self.c, self.u = c.astype(np.int64), np.repeat(np.arange(len(self.us)), followers)
            self.bucket = word_bucket(self.ws)
            self.move(part, turn, customers, root_tables)

        def move(self, part: pd.DataFrame, turn: int, customers: int, root_tables: int) -> None:
            kinds = part["kind"]
            self.t = np.minimum(self.c, 1)
            for data in part["data"][kinds == f"tables{turn}"]:
                self.t[self.c >= 2] = unpacked(data)[0]
            self.p, base = np.zeros(len(self.ws)), (ROOT_STRENGTH + ROOT_DISCOUNT * root_tables) / (ROOT_STRENGTH + customers) / (v + 1)
            asked = kinds == f"parent{turn}"
            for sender, data in zip(part["sender"][asked], part["data"][asked], strict=True):
                k, t = unpacked(data)
                self.p[self.bucket == sender] = (k - ROOT_DISCOUNT * t) / (ROOT_STRENGTH + customers) + base
            self.tables, self.customers = np.bincount(self.u, self.t, len(self.us)), np.bincount(self.u, self.c, len(self.us))
            for data in part["data"][kinds == f"totals{turn}"]:
                words, t, n = unpacked(data)
                at = np.searchsorted(self.us, words)
                self.tables[at], self.customers[at] = t, n

        def probabilities(self) -> np.ndarray:
            room = STRENGTH + self.customers
            return np.maximum(self.c - d * self.t, 0) / room[self.u] + ((STRENGTH + d * self.tables) / room)[self.u] * self.p[self.w]

    def context_step(turn: int, customers_: int, root_tables: int):
        """The contexts' Gibbs step: each dish's customers reseated against all other tables of the context."""

        def step(part: pd.DataFrame) -> pd.DataFrame:
            to = int(part["to"].iloc[0])
            own = Restaurants(part, turn, customers_, root_tables)
            many = np.flatnonzero(own.c >= 2)
            u, p = own.u[many], own.p[own.w[many]]
            with np.errstate(over="ignore"):
                key = mix(own.us[u] * np.uint64(3) + mix(own.ws[own.w[many]]) + np.uint64(2 * turn) * np.uint64(0x9E3779B97F4A7C15))
            t = draw_tables(own.c[many], (STRENGTH + d * (own.tables[u] - own.t[many])) * p, d * p, d, key)
            own.t[many] = t
            rows = [(to, f"tables{turn + 1}", to, packed(t.astype(np.int32)), 0, 0, 0), *customers(to, own.us, own.ws, own.u, own.w, own.t, own.c)]
            del own
            trim()
            return _frame(rows)

        return step

    # Parent and contexts take turns; of the samples after BURN rounds, tables and the parent's replies are kept.
    samples, words, own, tables, root_tables = [], asked, None, None, v
    for turn in range(ROUNDS):
        told = words.where("kind in ('words', 'common')")
        answers = (told if own is None else told.unionByName(own)).groupBy("to").applyInPandas(parent_step(turn, root_tables), MESSAGE)
        answers = stash(answers.withColumn("kind", F.when(F.col("kind").isin("parent", "totals"), F.concat("kind", F.lit(str(turn)))).otherwise(F.col("kind"))), "lm-parent")
        discard(words)
        release(spark)
        totals = answers.where("kind = 'root'").agg(F.sum("a"), F.sum("b")).first()
        seated, root_tables = int(totals[0] or 0), int(totals[1] or 0)
        own, replies = answers.where("kind = 'own'"), answers.where(F.col("kind").isin(f"parent{turn}", f"totals{turn}"))
        dynamic = replies if tables is None else replies.unionByName(tables)
        if turn >= BURN:
            samples.append((turn, seated, root_tables, dynamic))
        if turn + 1 < ROUNDS:
            words = stash(state.unionByName(dynamic).groupBy("to").applyInPandas(context_step(turn, seated, root_tables), MESSAGE), "lm-seats")
            tables = stash(words.where(F.col("kind") == f"tables{turn + 1}"), "lm-tables")
            release(spark)

    # The mean probability of each pair goes to the blocks that have it.
    def reply(part: pd.DataFrame) -> pd.DataFrame:
        to, rooms, mean = int(part["to"].iloc[0]), None, 0.0
        for turn, seated, root, _ in scalars:
            if rooms is None:
                rooms = Restaurants(part, turn, seated, root)
            else:
                rooms.move(part, turn, seated, root)
            mean = mean + rooms.probabilities() / len(scalars)
        del rooms
        trim()
        asked = part["kind"] == "places"
        rows = [(int(sender), "pairs", to, packed(shortened(mean[np.cumsum(unpacked(data)[0], dtype=np.int64)])), 0, 0, 0) for sender, data in zip(part["sender"][asked], part["data"][asked], strict=True)]
        trim()
        return _frame(rows)

    scalars = [(*s[:3], None) for s in samples]
    everything = merged
    for _, _, _, dynamic in samples:
        everything = everything.unionByName(dynamic)
    replies = stash(everything.groupBy("to").applyInPandas(reply, MESSAGE), "lm-replies")
    discard(merged)
    release(spark)

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        own = Block(part[part["kind"] == "block"]["data"].iloc[0], hot, nb)
        n, p = np.zeros(len(own.vocabulary)), np.ones(own.n_pairs)
        wanted, words = dict(_by_bucket(own.bucket, nb)), dict(_by_bucket(own.word_bucket, nb))
        for kind, sender, data in zip(part["kind"], part["sender"], part["data"], strict=True):
            if kind == "known":
                n[words[sender]] = unpacked(data)[0]
            elif kind == "pairs":
                p[wanted[sender]] = unpacked(data)[0]
        del wanted, words, part
        own.u = own.w = own.bucket = None
        base, doc = np.log10((n + 1) / (n_train + v + 1)), np.repeat(np.arange(len(own.sizes), dtype=np.int32), own.sizes)
        sums = lambda x: np.bincount(doc, x, len(own.sizes))
        score = sums(np.log10(p, out=p)[own.at])
        out = pd.DataFrame({"doc_id": pd.array(own.ids, "Int64"), "held_out": own.held, "n_tokens": own.sizes, "n_known": sums(n[own.codes] > 0).astype(np.int64), "train_tokens": n_train, "base_score": sums(base[own.codes]), "score": score})
        out["perplexity"] = 10.0 ** np.minimum(300, -score / own.sizes)
        out.loc[~own.valid, "doc_id"] = pd.NA
        del own, p
        trim()
        return out

    texts = blocks.select(F.col("block").alias("to"), F.lit("block").alias("kind"), F.lit(-1).cast("long").alias("sender"), "data", *(F.lit(0).cast("long").alias(x) for x in "abc"))
    parts = texts.unionByName(replies).unionByName(known)
    return parts.groupBy("to").applyInPandas(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")

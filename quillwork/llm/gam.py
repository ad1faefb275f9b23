"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are cut into bins. Cyclic boosting goes round the features and fits a shallow tree on the
logistic loss of one feature's bins at a time; the trees of a feature add up to its lookup table. The pairs whose residual
a split in both features lowers most get two-dimensional tables the same way. A score is the sum of looked-up values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.rules import SPACES, repeated_words
from quillwork.llm.shared import WordHashes, slices

#: The model is fitted on so many labelled rows at most: those with the least xxhash64(doc_id).
MOST_LABELLED = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 32, 8, 6, 120, 60, 0.1
THRESHOLD = 0.3
FEATURES = (
    "log_chars", "log_words", "word_length", "lower", "upper", "digit", "space", "symbol", "mark", "far", "line_words", "dup_lines",
    "distinct_words", "repeated", "commonest", "short_words", "long_words", "glued_marks", "lone_marks",
)

_KINDS = np.zeros(0x250, np.int64)  # 0 other, then lower, upper, digit, space, symbol, mark; 7 is far
for _c in range(0x250):
    _s = chr(_c)
    _KINDS[_c] = 5 if _s in "#*$%&|<>" else 1 if _s.islower() else 2 if _s.isupper() else 3 if _s.isdigit() else 4 if _s in SPACES else 6 if _s in ".,;:!?\"'()[]{}-_/\\=+@~^`" else 0


def features(texts: list[str], hashes: WordHashes) -> np.ndarray:
    """One row a text; a text without words has zeros where a share has no total."""
    n = len(texts)
    lengths = np.fromiter(map(len, texts), np.int64, n)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.where(codes < 0x250, _KINDS[np.minimum(codes, 0x24F)], 7)
    of = np.repeat(np.arange(n), lengths)
    counts = np.bincount(of * 8 + kinds, minlength=8 * n).reshape(n, 8).astype(float)
    lists = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, n)
    flat = [w for x in lists for w in x]
    h = hashes.of(flat)
    doc = np.repeat(np.arange(n), sizes)
    bytes_of = np.fromiter(map(len, flat), np.int64, len(flat))
    order = np.lexsort((h, doc))
    sh, sd = h[order], doc[order]
    first = np.ones(len(sh), bool)
    first[1:] = (sh[1:] != sh[:-1]) | (sd[1:] != sd[:-1])
    starts = np.flatnonzero(first)
    runs = np.diff(starts, append=len(sh))
    most = np.zeros(n)
    np.maximum.at(most, sd[starts], runs)
    words, chars = np.maximum(sizes, 1), np.maximum(lengths, 1)
    share = lambda x: np.bincount(doc, x, n) / words
    symbols = np.fromiter((w[-1] in b"#*$%&|<>!" and len(w) > 1 for w in flat), bool, len(flat))
    lone = np.fromiter((len(w) == 1 and not w.isalnum() for w in flat), bool, len(flat))
    lines, dups = np.ones(n), np.zeros(n)
    for k, text in enumerate(texts):
        kept = [x for x in text.split("\n") if x.strip(SPACES)]
        lines[k], dups[k] = max(1, len(kept)), (len(kept) - len(set(kept))) / max(1, len(kept))
    return np.stack(
        [
            np.log1p(lengths), np.log1p(sizes), np.bincount(doc, bytes_of, n) / words, *(counts[:, k] / chars for k in range(1, 8)), np.minimum(sizes / lines, 1000), dups,
            np.bincount(sd[starts], minlength=n) / words, repeated_words(h, sizes) / words, most / words, share(bytes_of <= 2), share(bytes_of >= 12), share(symbols), share(lone),
        ],
        1,
    )


@dataclass
class AdditiveModel:
    """edges: of each feature's bins; tables: a value a bin; pairs: (f, g, edges f, edges g, table)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], "right")]
        for f, g, ef, eg, table in self.pairs:
            total += table[np.searchsorted(ef, x[:, f], "right"), np.searchsorted(eg, x[:, g], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="midpoint"))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Where to split bins with gradient and curvature sums in two, and the gain."""
    if len(g) < 2:
        return 0, 0.0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
    k = int(np.argmax(gain))
    return k + 1, float(gain[k])


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of depth two over ordered bins: a Newton step a bin."""
    out = np.zeros(len(g))
    cut, gain = _best_cut(g, h)
    parts = [(0, cut), (cut, len(g))] if gain > 1e-9 else [(0, len(g))]
    for a, b in parts:
        inner, more = _best_cut(g[a:b], h[a:b]) if gain > 1e-9 else (0, 0.0)
        for s, e in [(a, a + inner), (a + inner, b)] if more > 1e-9 else [(a, b)]:
            out[s:e] = g[s:e].sum() / (h[s:e].sum() + 1)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Deterministic; rows must be in a fixed order. Without both labels the model is its base rate."""
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    edges = [_cuts(x[:, f], BINS) for f in range(x.shape[1])] if len(x) else [np.zeros(0)] * x.shape[1]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = AdditiveModel(base, edges, tables, [])
    if len(set(y.tolist())) < 2:
        return model
    at = np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)], 1)
    total = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(x.shape[1]):
            g, h = slopes()
            n = len(tables[f])
            step = RATE * _tree(np.bincount(at[:, f], g, n), np.bincount(at[:, f], h, n))
            tables[f] += step
            total += step[at[:, f]]
    coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    ca = np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)], 1)
    g, h = slopes()
    gains = []
    for f in range(x.shape[1]):
        for k in range(f):
            nf, nk = len(coarse[f]) + 1, len(coarse[k]) + 1
            both = ca[:, f] * nk + ca[:, k]
            gg, hh = np.bincount(both, g, nf * nk).reshape(nf, nk), np.bincount(both, h, nf * nk).reshape(nf, nk)
            gains.append((float((gg**2 / (hh + 1)).sum()), f, k))
    for _, f, k in sorted(gains, reverse=True)[:PAIRS]:
        nf, nk = len(coarse[f]) + 1, len(coarse[k]) + 1
        model.pairs.append((f, k, coarse[f], coarse[k], np.zeros((nf, nk))))
    for _ in range(PAIR_ROUNDS):
        for f, k, ef, ek, table in model.pairs:
            g, h = slopes()
            nf, nk = table.shape
            both = ca[:, f] * nk + ca[:, k]
            gg, hh = np.bincount(both, g, nf * nk).reshape(nf, nk), np.bincount(both, h, nf * nk).reshape(nf, nk)
            cut, _ = _best_cut(gg.sum(1), hh.sum(1))
            step = np.zeros((nf, nk))
            for s, e in ((0, cut), (cut, nf)):
                if e > s:
                    step[s:e] = RATE * _tree(gg[s:e].sum(0), hh[s:e].sum(0))
            table += step
            total += step.ravel()[both]
    return model


def held_out(key):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> AdditiveModel:
    """Fit on the labelled rows that are not held out, `most` of them at most (those with the least xxhash64 of the id)."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id"))
    rows = rows.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toPandas()
    ids, marks = rows["doc_id"].to_numpy(np.int64), rows["quality"].to_numpy(np.int64)
    order = np.argsort(ids)
    shared = docs.sparkSession.sparkContext.broadcast(ids[order])  # at most `most` ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            doc = batch.column(0)
            known = np.isin(np.asarray(doc.fill_null(0)), shared.value) & np.asarray(doc.is_valid())
            batch = batch.filter(pa.array(known))
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(list(features(texts[a:b], hashes)), pa.list_(pa.float64()))], names=["doc_id", "x"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = picked.mapInArrow(work, "doc_id long, x array<double>").toPandas()
    if not len(got):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = np.stack(got["x"].to_numpy())
    doc = got["doc_id"].to_numpy(np.int64)
    y = marks[order][np.searchsorted(ids[order], doc)].astype(float)
    fixed = np.lexsort((*x.T, doc))
    return fit(x[fixed], y[fixed])


def score(docs: DataFrame, model: AdditiveModel, text: str = "text", name: str = "score") -> DataFrame:
    """docs with a column of scores (0 to 1). All rows and columns stay; a null text counts as empty."""
    at, shared = docs.columns.index(text), docs.sparkSession.sparkContext.broadcast(model)
    names = [*docs.columns, name]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            scores = [shared.value.score(features(texts[a:b], hashes)) for a, b in slices(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(np.concatenate([np.zeros(0), *scores]), 9))], names=names)

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(work, StructType(list(docs.schema.fields)).add(name, DoubleType()))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs(doc_id, text), repeated rows included.

    Only `text` enters the score. A null or empty text is scored like any other. A null doc_id is neither learnt from nor held
    out. Without labels of both kinds every score is the base rate. An empty table gives an empty result.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(picked, train(picked, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

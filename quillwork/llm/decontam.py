"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

Words are lower-cased and stripped of punctuation. A document that holds an n-gram of an item is aligned with the item
around it, with costs for replaced, added and left out words, however many documents hold that n-gram. Only windows whose
words bound the score below the least one of a copy are left unaligned, so no copy is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.shared import mix, slices

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: A copy reaches this share of the item's best possible score, and so many matched words (or the whole item, if shorter).
RATIO, LEAST_WORDS = 0.5, 8
#: So many benchmark words are held and broadcast at once (some 40 bytes each); a larger benchmark goes in blocks.
BLOCK_WORDS = 500_000
TRIM = b".,;:!?\"'()[]{}<>*#$%&|-_/\\`~"


@dataclass
class Items:
    """A block of items: ids and words as numbers, and the sorted distinct words of each; `vocabulary` maps words to numbers, seeds are sorted hashes with the
    items and places (in words) that they stand at."""

    ids: list[int]
    words: list[np.ndarray]
    distinct: list[np.ndarray]
    vocabulary: dict[bytes, int]
    keys: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    places: np.ndarray


def normal(word: bytes) -> bytes:
    return word.strip(TRIM) or word


def words_in(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split() if text else []


def gram_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n-gram of words given as numbers."""
    h = mix(codes.astype(np.uint64) + np.uint64(1))
    out = h[: len(h) - n + 1].copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            out = mix(out + h[k : len(h) - n + 1 + k])
    return out


def index_items(rows: list[tuple[int, str]]) -> Items:
    vocabulary: dict[bytes, int] = {}
    ids, words, keys, items, places = [], [], [], [], []
    for item_id, text in rows:
        codes = np.array([vocabulary.setdefault(normal(w), len(vocabulary)) for w in words_in(text)], np.int64)
        if not len(codes):
            continue
        ids.append(item_id)
        words.append(codes)
        got = gram_keys(codes, min(SEED_WORDS, len(codes)))
        keys.append(got)
        items.append(np.full(len(got), len(ids) - 1))
        places.append(np.arange(len(got)))
    cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    keys, items, places = cat(keys, np.uint64), cat(items, np.int64), cat(places, np.int64)
    order = np.argsort(keys, kind="stable")
    found, starts = np.unique(keys[order], return_index=True)
    return Items(ids, words, [np.unique(w) for w in words], vocabulary, found, np.append(starts, len(keys)), items[order], places[order])


class Reader:
    """Texts of a slice as numbers of the items' vocabulary, -1 for other words, and the seeds that they hold."""

    def __init__(self, items: Items):
        self.items, self.codes = items, {}
        self.sizes = sorted({min(SEED_WORDS, len(w)) for w in items.words})

    def number(self, word: bytes) -> int:
        if len(self.codes) > 400_000:
            self.codes.clear()
        self.codes[word] = code = self.items.vocabulary.get(normal(word), -1)
        return code

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes of all words, the first word of each text (and the end), places of seeds and their numbers."""
        lists = [words_in(t) for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        get, number = self.codes.get, self.number
        codes = np.fromiter((c if (c := get(w)) is not None else number(w) for x in lists for w in x), np.int64, int(ends[-1]))
        doc = np.repeat(np.arange(len(texts)), np.diff(ends))
        places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in self.sizes:
            if len(codes) < n:
                continue
            known = codes >= 0
            ok = known[: len(codes) - n + 1].copy()
            for k in range(1, n):
                ok &= known[k : len(codes) - n + 1 + k]
            at = np.flatnonzero(ok & (doc[: len(codes) - n + 1] == doc[n - 1 :]))
            if len(at):
                keys = gram_keys(codes, n)[at]
                k = np.minimum(np.searchsorted(self.items.keys, keys), max(0, len(self.items.keys) - 1))
                hit = self.items.keys[k] == keys
                places.append(at[hit])
                seeds.append(k[hit])
        places, seeds = np.concatenate(places), np.concatenate(seeds)
        order = np.argsort(places, kind="stable")
        return codes, ends, places[order], seeds[order]


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local score and the span of text that it covers. Rows by numpy: a row's gaps along the text are a running maximum."""

    def best(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
        h = np.zeros(len(b) + 1, np.int64)
        steps = -GAP * np.arange(len(b) + 1)
        top = (0, 0, 0)
        for i, x in enumerate(a):
            t = np.maximum(h + GAP, 0)
            t[1:] = np.maximum(t[1:], h[:-1] + np.where(b == x, MATCH, MISMATCH))
            h = np.maximum.accumulate(t + steps) - steps
            j = int(np.argmax(h))
            if h[j] > top[0]:
                top = (int(h[j]), i + 1, j)
        return top

    score, rows, end = best(item, text)
    if not score:
        return 0, 0, 0
    _, _, back = best(item[:rows][::-1], text[:end][::-1])
    return score, end - back, end


def most_score(words: np.ndarray, text: np.ndarray) -> int:
    """A bound on the local score of an item, given as sorted distinct words: text words that the item lacks cost one each
    within an alignment, others add a match at most."""
    k = np.minimum(np.searchsorted(words, text), len(words) - 1)
    total = np.concatenate([[0], np.cumsum(np.where(words[k] == text, MATCH, MISMATCH))])
    return int((total - np.minimum.accumulate(total)).max())


def align(items: Items, codes: np.ndarray, places: np.ndarray, seeds: np.ndarray) -> list[tuple[int, int, float, int, int]]:
    """(item, score, ratio, first word, end) of the items that a text holds a copy of; places are in the text's words."""
    spans: dict[int, list[tuple[int, int]]] = {}
    for at, seed in zip(places.tolist(), seeds.tolist(), strict=True):
        for k in range(items.starts[seed], items.starts[seed + 1]):
            item, n = int(items.items[k]), len(items.words[items.items[k]])
            first = at - int(items.places[k]) - n // 2
            spans.setdefault(item, []).append((first, first + 2 * n))
    out = []
    for item, own in spans.items():
        own.sort()
        best, words, distinct = (0, 0, 0), items.words[item], items.distinct[item]
        least = max(RATIO * MATCH * len(words), MATCH * min(LEAST_WORDS, len(words)))
        a, b = own[0]
        for s, e in [*own[1:], (1 << 60, 0)]:
            if s <= b:
                b = max(b, e)
                continue
            low = max(a, 0)
            if most_score(distinct, codes[low:b]) >= least:
                found = smith_waterman(words, codes[low:b])
                if found[0] > best[0]:
                    best = (found[0], found[1] + low, found[2] + low)
            a, b = s, e
        if best[0] >= least:
            out.append((item, best[0], round(best[0] / (MATCH * len(words)), 6), best[1], best[2]))
    return out


def _each_text(reader: Reader, texts: list[str | None]):
    """(number of the text, its codes, places and seeds) for the texts that hold a seed."""
    for a, b in slices(texts):
        codes, ends, places, seeds = reader.read(texts[a:b])
        doc = np.searchsorted(ends, places, "right") - 1
        for k in np.unique(doc):
            own = doc == k if len(doc) < 64 else slice(*np.searchsorted(doc, [k, k + 1]))
            yield a + int(k), codes[ends[k] : ends[k + 1]], places[own] - ends[k], seeds[own]


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark as indexed blocks of bounded size."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    words = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-int(words) // BLOCK_WORDS)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) if n > 1 else rows
        items = index_items(sorted((r["item_id"], r["text"]) for r in part.collect()))
        if items.ids:
            yield items


FOUND = "doc_id long, item_id long, score long, ratio double, first_word long, end_word long"


def find_copies(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, ratio, first_word, end_word): one row a document and item that it holds a copy of, the best.

    Null or empty texts and items hold and are nothing. Repeated rows of a document give one row; a null doc_id counts as an
    id. An empty table on either side gives an empty result.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [x.split()[0] for x in FOUND.split(", ")]
    out = docs.sparkSession.createDataFrame([], FOUND)
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            reader = Reader(items)
            for batch in batches:
                rows = []
                ids = batch.column(0).to_pylist()
                for k, codes, places, seeds in _each_text(reader, batch.column(1).to_pylist()):
                    rows += [(ids[k], items.ids[i], score, ratio, a, b) for i, score, ratio, a, b in align(items, codes, places, seeds)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (*(pa.int64(),) * 3, pa.float64(), pa.int64(), pa.int64()), strict=True)], names=names)

        out = out.unionByName(picked.mapInArrow(find, FOUND))
    best = F.max(F.struct("score", "ratio", -F.col("first_word"), "end_word")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.score", "best.ratio", (-F.col("best.col3")).alias("first_word"), "best.end_word")


def drop_copies(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs without the rows that hold a copy of an item; all columns and all other rows stay as they are."""
    at, names = docs.columns.index(text), docs.columns
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            reader = Reader(items)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for k, codes, places, seeds in _each_text(reader, batch.column(at).to_pylist()):
                    clean[k] = not align(items, codes, places, seeds)
                yield pa.RecordBatch.from_arrays(batch.filter(pa.array(clean)).columns, names=names)

        docs = docs.mapInArrow(keep, docs.schema)
    return docs



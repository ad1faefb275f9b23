"""Quality rules: plain counts of words, symbols and repeats, and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into BUCKETS; their counts over the trusted documents and over all documents make two
multinomials with add-one smoothing. A document's score is the mean over its n-grams of log P(trusted) - log P(raw). One
trusted document in FOLDS is held out of the trusted counts. The threshold is the one that tells these best from the
documents labelled as not trusted, of those that reject MOST_FALSE of them at most; it decides every document alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.shared import WordHashes, mix, slices, stash

BUCKETS = 1 << 16
FOLDS, MOST_FALSE = 5, 0.05
#: The threshold is sought among multiples of it.
STEP = 1e-4
#: Marks of a row by its label.
COUNTED, HELD, OTHER = 1, 2, 3
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: The labelled ids are broadcast up to so many (8 bytes each); beyond it the documents are joined to them.
MOST_IDS = 2_000_000


def words_as_is(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hashed_grams(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, number of words of each, and buckets: words first, then pairs, with -1 across texts."""
    lists = [words_as_is(t) for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    h = hashes.of([w for x in lists for w in x])
    ends = np.cumsum(sizes)
    single = (mix(h) % np.uint64(BUCKETS)).astype(np.int64)
    pair = np.full(len(h), -1, np.int64)
    if len(h) > 1:
        pair[:-1] = (mix(mix(h[:-1]) + h[1:]) % np.uint64(BUCKETS)).astype(np.int64)
        pair[ends[ends > 0] - 1] = -1
    return h, sizes, np.stack([single, pair])


def with_marks(docs: DataFrame, trusted: DataFrame, others: DataFrame | None) -> tuple[DataFrame, Callable[[pa.RecordBatch], np.ndarray]]:
    """docs(doc_id, text), and a function that gives the marks of a batch of it: COUNTED or HELD for `trusted`(doc_id), OTHER
    for the rest of `others`(doc_id), else 0. By a broadcast of checked size, else by a third column that a join has made."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("good"))
    if others is not None:
        ids = ids.unionByName(others.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(False).alias("good")))
    ids = ids.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("good").alias("good"))
    few = ids.limit(MOST_IDS + 1).toPandas().sort_values("doc_id")

    def marks(key: np.ndarray, good: np.ndarray, labelled: np.ndarray) -> np.ndarray:
        held = mix(key.astype(np.uint64)) % np.uint64(FOLDS) == 0
        return np.where(labelled, np.where(good, np.where(held, HELD, COUNTED), OTHER), 0)

    if len(few) > MOST_IDS:
        joined = docs.join(ids, "doc_id", "left").select("doc_id", "text", F.when(F.col("good"), 1).otherwise(F.when(~F.col("good"), 0).otherwise(-1)).alias("good"))

        def by_join(batch: pa.RecordBatch) -> np.ndarray:
            good = np.asarray(batch.column(2))
            return marks(np.asarray(batch.column(0).fill_null(0)), good == 1, good >= 0)

        return joined, by_join
    shared = docs.sparkSession.sparkContext.broadcast((few["doc_id"].to_numpy(np.int64), few["good"].to_numpy(bool)))

    def by_ids(batch: pa.RecordBatch) -> np.ndarray:
        ids, good = shared.value
        key = np.asarray(batch.column(0).fill_null(0))
        if not len(ids):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(ids, key), len(ids) - 1)
        return marks(key, good[at], (ids[at] == key) & np.asarray(batch.column(0).is_valid()))

    return docs, by_ids


def gram_counts(docs: DataFrame, known: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """(bucket, raw, trusted): n-gram counts over all documents and over the trusted ones that aren't held out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, totals = WordHashes(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            texts, trust = batch.column(1).to_pylist(), known(batch) == COUNTED
            for a, b in slices(texts):
                _, sizes, grams = hashed_grams(texts[a:b], hashes)
                of_word = np.repeat(trust[a:b], sizes)
                for row in grams:
                    ok = row >= 0
                    totals[0] += np.bincount(row[ok], minlength=BUCKETS)
                    totals[1] += np.bincount(row[ok & of_word], minlength=BUCKETS)
        used = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(totals[0, used]), pa.array(totals[1, used])], names=["bucket", "raw", "trusted"])

    return docs.mapInArrow(count, "bucket int, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """One value a bucket; a bounded table, whatever the input."""
    rows = counts.toPandas()
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], trusted[rows["bucket"]] = rows["raw"], rows["trusted"]
    if not trusted.sum():
        return np.zeros(BUCKETS)
    return np.log((trusted + 1) / (trusted.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def repeated_words(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text the number of its words that stand in a 3-word window found twice or more in it."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    covered = np.zeros(len(h), bool)
    if len(h) > 2:
        with np.errstate(over="ignore"):
            key = mix(mix(mix(h[:-2]) + h[1:-1]) + h[2:]) + mix(doc[:-2].astype(np.uint64))
        at = np.flatnonzero(doc[:-2] == doc[2:])
        key = key[at]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            covered[at[twice] + k] = True
    return np.bincount(doc, covered, len(sizes)).astype(np.int64) if len(doc) else np.zeros(len(sizes), np.int64)


MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, mark long"


def measure(docs: DataFrame, known: Callable[[pa.RecordBatch], np.ndarray], ratios: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    names = [x.split()[0] for x in MEASURES.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, marks = [t or "" for t in batch.column(1).to_pylist()], known(batch)
            for a, b in slices(texts):
                part = texts[a:b]
                h, sizes, grams = hashed_grams(part, hashes)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                total, n = np.zeros(len(sizes)), np.zeros(len(sizes))
                for row in grams:
                    ok = row >= 0
                    total += np.bincount(doc[ok], shared.value[row[ok]], len(sizes))
                    n += np.bincount(doc[ok], minlength=len(sizes))
                chars, symbols, dups = [], [], []
                for text in part:
                    chars.append(len(text) - sum(map(text.count, SPACES)))
                    symbols.append(sum(map(text.count, SYMBOLS)))
                    lines = [x for x in text.split("\n") if x.strip(SPACES)]
                    dups.append(len(lines) - len(set(lines)))
                columns = [batch.column(0).slice(a, b - a), sizes, chars, symbols, dups, repeated_words(h, sizes), np.round(total / np.maximum(n, 1), 9), marks[a:b]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return docs.mapInArrow(work, MEASURES)


def calibrate(rows: DataFrame) -> tuple[float, float, float] | None:
    """(cut, share of the held-out trusted rows below it, share of the others below it), from rows(ratio, mark): counts by
    steps of the ratio, a bounded table. None without held-out rows; without others the highest cut within MOST_FALSE."""
    step = F.floor(F.col("ratio") / STEP).cast("long").alias("step")
    found = rows.where(F.col("mark") > COUNTED).groupBy(step).agg(*(F.sum((F.col("mark") == m).cast("long")).alias(k) for m, k in ((HELD, "held"), (OTHER, "other")))).toPandas().sort_values("step")
    held, other = found["held"].to_numpy(np.int64), found["other"].to_numpy(np.int64)
    if not held.sum():
        return None
    wrong, right = (np.concatenate([[0], np.cumsum(x)[:-1]]) / max(x.sum(), 1) for x in (held, other))
    fits = np.flatnonzero(wrong <= MOST_FALSE)
    k = fits[np.argmax((right - wrong)[fits])] if other.sum() else fits[-1]
    return round(float(found["step"].iloc[k]) * STEP, 6), float(wrong[k]), float(right[k])


def judge_quality(docs: DataFrame, trusted: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Counts, base_failed, ratio and kept for every row of docs(doc_id, text); trusted(doc_id) names the target documents,
    others(doc_id) those labelled as not of the target.

    A null or empty text has no words and fails the base rules. Repeated rows are judged each; a null doc_id is never
    labelled, an id named as both is trusted. With no trusted document to count the ratio is 0, and with none held out that
    passes the base rules these alone decide. An empty table gives an empty result.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked, known = with_marks(picked, trusted, others)
    rows = stash(measure(marked, known, log_ratios(gram_counts(marked, known))), "quality-measures")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    found = calibrate(rows.where(~F.col("base_failed")))
    cut = found[0] if found else -1e9
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= cut)).drop("mark").withColumn("cut", F.lit(cut))

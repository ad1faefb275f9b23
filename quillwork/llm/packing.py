"""Best-fit decreasing packing of tokenised documents into sequences of a fixed capacity.

What best-fit decreasing does depends on the lengths alone, so the plan is made on the histogram of lengths (at
most `capacity` entries): lengths descend, a segment tree over the remaining capacities finds the tightest open bin
in logarithmic time, and runs of equal pieces in equal bins are placed as ranges. The ranges say where the k-th
piece of a length goes, so pieces find their place by their rank among those of their length, without meeting.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.shared import Codes, slices, stash

CAPACITY = 2048
#: Words that a worker keeps the ids of.
MOST_WORDS = 500_000


class CapacityTree:
    """A segment tree over remaining capacities 0..size-1; a leaf holds the number of open bins with that room."""

    def __init__(self, size: int):
        self.leaves = 1 << (size - 1).bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        at = room + self.leaves
        while at:
            self.open[at] += bins
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room >= need that has an open bin."""
        at = need + self.leaves
        if need >= self.leaves:
            return None
        if self.open[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over {length: pieces}. Rows (length, first rank, pieces, first bin, pieces a bin, first offset),
    where the k-th piece of a row goes to bin first + k // a, at offset + (k % a) * length; and the number of bins."""
    tree, rooms, rows, bins = CapacityTree(capacity + 1), {}, [], 0

    def put(room: int, first: int, count: int) -> None:
        if count:
            rooms.setdefault(room, deque()).append((first, count))
            tree.add(room, count)

    for length in sorted((n for n, k in histogram.items() if k and n), reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                per = capacity // length
                count = -(-left // per)
                first, room = bins, capacity
                bins += count
            else:
                per = room // length
                first, count = rooms[room].popleft()
                tree.add(room, -count)
            full, rest = divmod(min(left, count * per), per)
            if full:
                rows.append((length, rank, full * per, first, per, capacity - room))
                put(room - per * length, first, full)
                rank += full * per
            if rest:
                rows.append((length, rank, rest, first + full, rest, capacity - room))
                put(room - rest * length, first + full, 1)
                rank += rest
            left -= full * per + rest
            used = full + bool(rest)
            if used < count:  # bins that stay as they were go first again
                rooms.setdefault(room, deque()).appendleft((first + used, count - used))
                tree.add(room, count - used)
    return rows, bins


class WordTokenizer:
    """Ids of whole texts by a `tokenizers` file, words remembered.

    Texts of code points below U+0300 are cut into the tokenizer's own pre-tokens here (lower case, white space dropped;
    no composition can happen there), and each distinct one is encoded once. All other texts, and those with one of the
    tokenizer's special tokens, are encoded whole.
    """

    #: Fixed value: the file's pre-token pattern.
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.ends = np.zeros(max(spec["model"]["vocab"].values()) + 1 + len(self.special), bool)
        for token, i in spec["model"]["vocab"].items():
            self.ends[i] = token.endswith("</w>")
        self.find = regex.compile(self.PIECES).findall
        self.far = regex.compile("[İ̀-\U0010ffff]").search
        self.clear()

    def clear(self) -> None:
        self.codes, self.flat, self.starts = Codes(), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self) -> None:
        fresh = list(self.codes)[len(self.starts) - 1 :]
        ids, sizes = [], []
        for a in range(0, len(fresh), 2000):
            part = fresh[a : a + 2000]
            got = self.whole(" ".join(part))
            last = np.flatnonzero(self.ends[got])
            if len(last) == len(part):
                ids.append(got)
                sizes.append(np.diff(last, prepend=-1))
            else:
                for word in part:
                    ids.append(self.whole(word))
                    sizes.append(np.array([len(ids[-1])]))
        if fresh:
            self.flat = np.concatenate([self.flat, *ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.codes) > MOST_WORDS:
            self.clear()
        words, sizes, odd = [], [], {}
        for k, text in enumerate(texts):
            if self.far(text) or any(s in text for s in self.special):
                odd[k], n = self.whole(text), 0
            else:
                words += (found := self.find(text.lower()))
                n = len(found)
            sizes.append(n)
        at = self.codes.of(words)
        self.learn()
        starts, lengths = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.flat[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        a = 0
        for k, n in enumerate(sizes):
            yield odd[k] if k in odd else flat[ends[a] : ends[a + n]]
            a += n


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long, chunk int, nth long"


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row a piece: ids of the text, then id 0, cut only where longer than the capacity. chunk and nth: the task, and
    the piece's rank among its task's pieces of that length. ids (array) only with keep_ids."""

    def cut(batches):
        from pyspark import TaskContext

        tok, chunk, seen = tokenizer(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for a, b in slices(texts):
                out = []
                for doc, ids in zip(batch["doc_id"].iloc[a:b], tok.encode(texts[a:b]), strict=True):
                    ids = np.append(ids, np.uint32(0)).astype("<u4")
                    for k, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s : s + capacity]
                        n = seen[len(part)] = seen.get(len(part), -1) + 1
                        out.append((doc, k, s, len(part), zlib.crc32(part.tobytes()), chunk, n) + ((part.astype(np.int64),) if keep_ids else ()))
                yield pd.DataFrame(out, columns=names)

    schema = PIECE + (", ids array<long>" if keep_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(cut, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """All pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A null or empty text is the single id 0. Repeated rows are packed each; a null doc_id stays null. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    pieces = stash(cut_pieces(docs, path, capacity, keep_ids), "pieces")
    counts = stash(pieces.groupBy("length", "chunk").agg((F.max("nth") + 1).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    rows, _ = plan_bins(histogram, capacity)
    table = np.array(rows or [(0, 0, 0, 0, 1, 0)], np.int64)
    keys = table[:, 0].astype(np.uint64) << np.uint64(48) | table[:, 1].astype(np.uint64)
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], table[order]))  # some entries a length: bounded by the capacity

    from pyspark.sql.window import Window

    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("length", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "chunk"])

    def place(batches):
        keys, table = shared.value
        for batch in batches:
            rank = (batch["nth"] + batch["before"]).to_numpy(np.int64)
            row = table[np.searchsorted(keys, batch["length"].to_numpy(np.uint64) << np.uint64(48) | rank.astype(np.uint64), "right") - 1]
            k = rank - row[:, 1]
            out = batch[names[:-2]].copy()
            out["sequence_id"] = row[:, 3] + k // row[:, 4]
            out["offset"] = row[:, 5] + k % row[:, 4] * row[:, 0]
            yield out[names]

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if keep_ids else "") + ", sequence_id long, offset long"
    names = [x.split()[0] for x in schema.split(", ")]
    return ranked.mapInPandas(place, schema)

"""Near duplicates: an exact Jaccard join on word shingles, and its connected components.

Documents with equal shingle sets are one node. Two nodes of similarity 0.8 or more share a shingle among the n // 5 + 1 first
of each set in one global order, the prefix; shingles that a sketch finds very common come last in that order. Nodes that
share a prefix shingle form a tile.

* A tile without crowded size bands gives its pairs whose sizes allow the similarity. Summed over all tiles, a pair's shared prefix shingles bound
  its intersection from above: what the set whose prefix ends first has in common with the other lies in its prefix, where it
  is counted, or in its rest. Pairs below the bound, nearly all accidental ones, go before any set is read.
* Any other tile is large and gives no pairs but a star: in each size band, every node with the one whose prefix is shared most.
* The sets of surviving pairs meet in cells of bounded size, where hashed bitmaps bound the intersection once more (the set
  bits that differ are at most the elements that do) and the intersection of the sorted arrays decides.
* Large tiles whose nodes the links have not joined into one component are compared in full, as size-banded tiles: pieces of
  bounded size meet two by two, none of them both of the largest component. Unlike texts that share a passage go before any set is
  read: the elements that two sets have in each range of the hash bound their intersection. What comes out are links, at most one
  a node of a cell, never the pairs that were looked at.

Words, shingles and sets are 64-bit hashes. A very long text is one larger set, held as a whole by the tasks that need it.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.shared import WordHashes, discard, mix, release, slices, stash, words_of

SHINGLE, PERCENT = 5, 80
#: Buckets of the sketch of common shingles, the blocks and salts by which it is added up, and how far above the mean, in
#: deviations of a Poisson count, and how full at least, a common bucket is.
SKETCH, BLOCKS, SALTS, DEVIATIONS, LEAST_COMMON = 1 << 20, 256, 64, 6, 16
#: Tiles where no node has more others above it within its size band give all such pairs; others a star each band.
SMALL_TILE = 12
#: Nodes of a piece of a large tile, or of a large candidate component; two pieces meet in a cell.
TILE = 512
#: Candidate components up to this many nodes are one cell.
MOST_TOGETHER = 256
#: A shingle of more documents than this, by the sketch, is dealt over several tasks.
HOT = 1 << 17
#: Bits of a signature: the least power of two that is so many times the set's size, and at least so many.
BITS_EACH, LEAST_BITS = 16, 256
#: A set's elements are counted by ranges of the hash: a power of two of them, each for so many elements at most, on average.
RANGE, MOST_COUNTED = 8, 255
#: Bits of the largest Bloom filter of wanted ids; 8 MB.
MOST_BITS = 1 << 26
#: Sets that one task takes, about, and pairs.
NODES_A_TASK, PAIRS_A_TASK = 500, 2_500
#: Seats that are broadcast at most, at 12 bytes each; more are joined by a shuffle.
MOST_SEATS = 1 << 20


def shingle_sets(texts: list[str | None], hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each text; a text of fewer words is one shingle, of none an empty set."""
    lists = [words_of(t) for t in texts]
    h = mix(hashes.of([w for x in lists for w in x]))
    joint = h.copy()
    with np.errstate(over="ignore"):
        for k in range(1, min(SHINGLE, len(h))):
            joint[: len(h) - k] = mix(joint[: len(h) - k] * np.uint64(3) + h[k:])
    out, at = [], 0
    for words in lists:
        n = len(words)
        if n >= SHINGLE:
            own = np.sort(joint[at : at + n - SHINGLE + 1])
            if n > SHINGLE:
                keep = np.ones(len(own), bool)
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                own = own[keep]
        elif n:
            own = h[at : at + 1].copy()
            with np.errstate(over="ignore"):
                for k in range(1, n):
                    own = mix(own * np.uint64(5) + h[at + k])
                own = mix(own + np.uint64(n))
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
        at += n
    return out


def node_of(own: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    with np.errstate(over="ignore"):
        x = mix(own + np.uint64(0x9E3779B97F4A7C15))
        both = mix(np.array([x.sum(dtype=np.uint64) + np.uint64(len(own))])) + mix(np.array([np.bitwise_xor.reduce(mix(x * np.uint64(7)))]))
    return int(both.view(np.int64)[0])


def signature(own: np.ndarray) -> np.ndarray:
    """A bitmap as large as the set needs: bit h of each hashed element, h by the low bits, so that halves can be folded."""
    size = max(LEAST_BITS, 1 << (BITS_EACH * len(own) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(mix(own) & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)[None]


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of equally long bitmaps (uint64 words) folded to fewer words: the bitmap that the set has at that size."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def ranges_of(own: np.ndarray) -> np.ndarray:
    """How many elements of a set are in each of equal ranges of the hash, at most MOST_COUNTED (uint8)."""
    power = max(4, (len(own) // RANGE).bit_length())
    return np.minimum(np.bincount((own >> np.uint64(64 - power)).astype(np.int64), minlength=1 << power), MOST_COUNTED).astype(np.uint8)


def ranged(counts: list[np.ndarray]) -> np.ndarray:
    """A row of counts for each set, all by the widest ranges among them. A set whose counts are cut off is compared by nothing: zeros
    stand for all."""
    width = min(map(len, counts))
    rows = np.stack([c.astype(np.int32).reshape(width, -1).sum(1) for c in counts])
    return np.zeros_like(rows) if max(int(c.max()) for c in counts) >= MOST_COUNTED else rows


def prefix(own: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first n // 5 + 1 elements in the global order: by how common, then by hash."""
    n = len(own) * (100 - PERCENT) // 100 + 1
    rank = common[(own & np.uint64(SKETCH - 1)).astype(np.int64)]
    if rank.any():
        return own[np.lexsort((own, rank))[:n]]
    return own[:n]


def _arrays(columns, types, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _each_set(batches: Iterator[pa.RecordBatch], column: int):
    hashes = WordHashes()
    for batch in batches:
        texts = batch.column(column).to_pylist()
        for a, b in slices(texts):
            yield batch, a, b, shingle_sets(texts[a:b], hashes)


def document_nodes(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """A table (doc_id, n_shingles, node, ranges), node and ranges null for empty sets, and the sketch: how common each bucket is (0: not)."""
    names = ["doc_id", "n_shingles", "node", "ranges", "block", "salt", "filled"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
    wide = SKETCH // BLOCKS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sketch = np.zeros(SKETCH, np.int64)
        for batch, a, b, sets in _each_set(batches, 1):
            nodes = [node_of(s) if len(s) else None for s in sets]
            n, ranges = len(sets), [ranges_of(s).tobytes() if len(s) else None for s in sets]
            yield _arrays([batch.column(0).slice(a, b - a).to_pylist(), list(map(len, sets)), nodes, ranges, [None] * n, [None] * n, [None] * n], types, names)
            if n:
                sketch += np.bincount((np.concatenate(sets) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        if sketch.any():
            none, salt = [None] * BLOCKS, TaskContext.get().partitionId() % SALTS
            yield _arrays([none, none, none, none, range(BLOCKS), [salt] * BLOCKS, [_pressed(x) for x in sketch.reshape(BLOCKS, wide)]], types, names)

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(wide, np.int64)
        for x in part["filled"]:
            total += _unpressed(x)
        return pd.DataFrame({"block": [part["block"].iloc[0]], "filled": [_pressed(total)]})

    both = stash(docs.mapInArrow(work, "doc_id long, n_shingles long, node long, ranges binary, block int, salt int, filled binary"), "shingle-nodes")
    salted = both.where("block is not null").groupBy("block", "salt").applyInPandas(add, "block int, filled binary")
    sketch = np.zeros((BLOCKS, wide), np.int64)
    for block, filled in salted.groupBy("block").applyInPandas(add, "block int, filled binary").toPandas().itertuples(index=False):  # SKETCH numbers
        sketch[block] = _unpressed(filled)
    sketch, mean = sketch.ravel(), sketch.mean()
    common = np.where(sketch >= max(LEAST_COMMON, mean + DEVIATIONS * math.sqrt(mean)), sketch, 0)
    table = both.where("n_shingles is not null").select("doc_id", "n_shingles", "node", "ranges")
    table._stashed = both._stashed
    return table, common


def _pressed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpressed(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def shared_shingles(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """What the prefix shingles of all nodes have in common, as a table (x, y, size_x, size_y, shared, tile, part, nodes, sizes).

    Pairs of small tiles, x < y, with the number of prefix shingles they share in this task's tiles; and large tiles, with their
    nodes (int64, little-endian), sizes (int32) and the number of shingles that have just these nodes. The tiles of a shingle
    dealt over several tasks are parts of one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, _, _, sets in _each_set(batches, 0):
            keys, nodes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for own in sets:
                if not len(own) or (node := node_of(own)) in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(node)
                first = prefix(own, shared.value)
                keys.append(first)
                nodes.append(np.full(len(first), node, np.int64))
                sizes.append(np.full(len(first), len(own), np.int32))
            key, node = np.concatenate(keys), np.concatenate(nodes)
            over = shared.value[(key & np.uint64(SKETCH - 1)).astype(np.int64)] // HOT
            part = np.where(over > 0, 1 + (mix(node.view(np.uint64)) % (over + 1).astype(np.uint64)).astype(np.int64), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part), pa.array(node), pa.array(np.concatenate(sizes))], names=["key", "part", "node", "size"])

    names = ["x", "y", "size_x", "size_y", "shared", "tile", "part", "nodes", "sizes"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [tuple(np.asarray(b.column(k)) for k in range(4)) for b in batches]
        if not parts:
            return
        key, part, node, size = (np.concatenate([p[k] for p in parts]) for k in range(4))
        del parts
        # One entry a shingle and node; shingles of a single node are done with.
        order = np.lexsort((node, size, part, key))
        key, part, node, size = key[order], part[order], node[order], size[order].astype(np.int64)
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, part, node, size = key[fresh], part[fresh], node[fresh], size[fresh]
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
        length = np.diff(starts, append=len(key))
        whose, end = np.repeat(np.arange(len(starts)), length), np.repeat(starts + length, length)
        # A tile is large if some node and the SMALL_TILE-th after it are of one band.
        far = np.arange(len(key)) + SMALL_TILE
        crowded = far < end
        crowded[crowded] = PERCENT * size[far[crowded]] <= 100 * size[crowded]
        large = np.bincount(whose, crowded | (part > 0), len(starts)) > 0
        left, pairs = np.flatnonzero(~large[whose]), []
        for k in range(1, SMALL_TILE):
            left = left[left + k < end[left]]
            left = left[PERCENT * size[left + k] <= 100 * size[left]]
            if not len(left):
                break
            pairs.append((left, left + k))
        if pairs:
            i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
            i, j = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
            order = np.lexsort((node[j], node[i]))
            i, j = i[order], j[order]
            x, y = node[i], node[j]
            at = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            columns = [pa.array(x[at]), pa.array(y[at]), pa.array(size[i[at]].astype(np.int32)), pa.array(size[j[at]].astype(np.int32)), pa.array(np.diff(at, append=len(x)).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(at), t) for t in types[5:])], names=names)
        found: dict[tuple[int, int], list] = {}
        for s, n in zip(starts[large].tolist(), length[large].tolist(), strict=True):
            own = slice(s, s + n)
            if part[s] or n > 1:
                tile = (int(key[s]), int(part[s])) if part[s] else (node_of(np.sort(node[own]).view(np.uint64)), 0)
                found.setdefault(tile, [0, own])[0] += 1
        for (tile, k), (times, own) in found.items():
            yield _arrays([[None], [None], [None], [None], [times], [tile], [k], [node[own].astype("<i8").tobytes()], [size[own].astype("<i4").tobytes()]], types, names)

    posted = docs.select("text").mapInArrow(post, "key long, part int, node long, size int")
    schema = "x long, y long, size_x int, size_y int, shared int, tile long, part int, nodes binary, sizes binary"
    return stash(posted.repartition("key", "part").mapInArrow(meet, schema), "shared-shingles")


def tile_members(found: DataFrame) -> DataFrame:
    """The large tiles as a table (tile, node, size, band, large): large is how many shingles the node has in such tiles."""
    runs = found.where("tile is not null").groupBy("tile", "part").agg(F.sum("shared").alias("shared"), F.first("nodes").alias("nodes"), F.first("sizes").alias("sizes"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, shared, nodes, sizes in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                own = np.frombuffer(nodes.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), tile)), pa.array(own), pa.array(np.frombuffer(sizes.as_buffer(), "<i4")), pa.array(np.full(len(own), shared))], names=["tile", "node", "size", "shared"])

    band = F.floor(F.log("size") / math.log(100 / PERCENT) + 1e-9).cast("int")
    members = runs.mapInArrow(unpack, "tile long, node long, size int, shared long").withColumn("band", band)
    large = members.groupBy("node").agg(F.sum("shared").alias("large"))
    return stash(members.join(large, "node").drop("shared"), "tile-members")


def allowed(shared: Column, size_x: str, size_y: str) -> Column:
    """Whether two sets that share so many prefix shingles at most can be similar."""
    rest = lambda s: F.col(s) - F.floor(F.col(s) * (100 - PERCENT) / 100) - 1
    sizes = (100 * F.col(size_x) >= PERCENT * F.col(size_y)) & (100 * F.col(size_y) >= PERCENT * F.col(size_x))
    return sizes & ((100 + PERCENT) * (shared + F.greatest(rest(size_x), rest(size_y))) >= PERCENT * (F.col(size_x) + F.col(size_y)))


def candidates(found: DataFrame, members: DataFrame) -> DataFrame:
    """(x, y): pairs of the small tiles that the count of shared prefix shingles allows, and the stars of the large tiles.

    A pair that shares no small tile shares at most as many shingles as the one of fewer shingles in large tiles has.
    """
    large = members.groupBy("node").agg(F.first("large").alias("large"))
    sided = lambda k: large.select(F.col("node").alias(k), F.col("large").alias(f"large_{k}"))
    pairs = found.where("x is not null").groupBy("x", "y", "size_x", "size_y").agg(F.sum("shared").alias("shared"))
    pairs = pairs.join(sided("x"), "x", "left").join(sided("y"), "y", "left")
    most = F.col("shared") + F.least(F.coalesce("large_x", F.lit(0)), F.coalesce("large_y", F.lit(0)))
    pairs = pairs.where(allowed(most, "size_x", "size_y")).select("x", "y")
    share = F.col("large") / (F.floor(F.col("size") * (100 - PERCENT) / 100) + 1)
    centres = members.groupBy("tile", "band").agg(F.max(F.struct(share.alias("share"), F.col("node").alias("centre"), F.col("size").alias("centre_size"), F.col("large").alias("centre_large"))).alias("c"))
    stars = members.join(centres.select("tile", "band", "c.*"), ["tile", "band"]).where("node <> centre")
    stars = stars.where(allowed(F.least("large", "centre_large"), "size", "centre_size")).select(F.least("node", "centre").alias("x"), F.greatest("node", "centre").alias("y"))
    return stash(pairs.unionByName(stars).distinct(), "candidate-pairs")


def candidate_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, elements) of the nodes (node, doc_id), each read from that document; rows that repeat it give it again, and
    other texts under the same id, a null one included, give theirs, as do some that a Bloom filter of the ids lets through.

    The filter has 16 bits an id. For more than MOST_BITS / 16 ids it would pass a bound, and the ids are joined instead.
    """
    count = nodes.count()
    width = 1 << max(16, (16 * count - 1).bit_length())

    def places(ids: pa.Array) -> Iterator[np.ndarray]:
        x = mix(np.asarray(ids.fill_null(-1)).astype(np.int64).view(np.uint64))
        for _ in range(4):
            x = mix(x + np.uint64(1))
            yield (x & np.uint64(width - 1)).astype(np.int64)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(width, bool)
        for batch in batches:
            for at in places(batch.column(0)):
                bits[at] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(words[used])], names=["at", "bits"])

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, sets in _each_set(batches, 0):
            full = [s for s in sets if len(s)]
            yield _arrays([list(map(node_of, full)), [s.astype("<u8").tobytes() for s in full]], [pa.int64(), pa.binary()], ["node", "elements"])

    if width > MOST_BITS:
        ids = nodes.select(F.col("doc_id").alias("wanted")).distinct()
        picked = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
        return stash(picked.mapInArrow(sets_of, "node long, elements binary"), "candidate-sets")
    words = nodes.select("doc_id").mapInArrow(fill, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    bloom = np.zeros(width // 64, np.int64)
    bloom[words["at"]] = words["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(bloom.view(np.uint8))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = np.ones(batch.num_rows, bool)
                for at in places(batch.column(0)):
                    hit &= (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(hit))], names=["text"])

        return sets_of(passed())

    return stash(docs.select("doc_id", "text").mapInArrow(pick, "node long, elements binary"), "candidate-sets")


def most_overlap(size_x, size_y, bits_x: np.ndarray, bits_y: np.ndarray):
    """An upper bound of the intersection's size: differing bits are at most the differing elements."""
    differ = np.bitwise_count(bits_x ^ bits_y).sum(-1, dtype=np.int64)
    return (size_x + size_y - differ) // 2


def similar(overlap, size_x, size_y):
    return 100 * overlap >= PERCENT * (size_x + size_y - overlap)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The similarity of two sorted arrays, by their exact intersection."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return bool(similar(int((b[np.minimum(at, len(b) - 1)] == a).sum()), len(a), len(b)))


class Joined(dict):
    """Union-find; the root of what was never joined is itself."""

    def root(self, k):
        while (up := self.get(k, k)) != k:
            self[k] = self.get(up, up)
            k = up
        return k

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (x, y) that join what the similar ones among the pairs join.

    Pairs are dealt by a label that two rounds of taking the least neighbour give, so that a group's sets travel about once; a
    label of more than MOST_TOGETHER nodes is cut into pieces, and a set goes to the cells of its pairs alone.
    """
    ways = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = ways.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("least"))
    label = ways.join(least.select(F.col("x").alias("y"), "least"), "y").groupBy("x").agg(F.min("least").alias("least"))
    label = label.join(least.withColumnRenamed("least", "own"), "x").select(F.col("x").alias("node"), F.least("least", "own").alias("label"))
    label = stash(label, "candidate-labels")
    pieces = label.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select("label", F.when(F.col("n") <= MOST_TOGETHER, 1).otherwise(F.ceil(F.col("n") / MOST_TOGETHER)).alias("pieces"))
    dealt = pairs.join(label.withColumnRenamed("node", "x"), "x").join(pieces, "label")
    i, j = (F.pmod(F.xxhash64(k), F.col("pieces")) for k in ("x", "y"))
    cell = F.xxhash64("label", F.least(i, j), F.greatest(i, j))
    celled = stash(dealt.select("x", "y", cell.alias("cell")), "candidate-cells")
    seats = celled.select("cell", F.col("x").alias("node")).unionByName(celled.select("cell", F.col("y").alias("node")))
    counts = celled.agg(F.count(F.lit(1)).alias("pairs"), F.approx_count_distinct(F.xxhash64("cell", "x")).alias("nodes")).first()
    tasks = max(1, -(-counts["nodes"] // NODES_A_TASK), -(-counts["pairs"] // PAIRS_A_TASK))
    task = F.pmod(F.col("cell"), F.lit(tasks)).cast("int").alias("task")
    seats = seats.select(task, "node").distinct()
    seated = sets.join(F.broadcast(seats) if counts["nodes"] <= MOST_SEATS else seats, "node").select("task", "node", "elements")

    def decide(edges: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        arrays = {k: np.frombuffer(e, "<u8") for k, e in zip(own["node"], own["elements"], strict=True)}
        bits: dict[int, np.ndarray] = {}

        def may_be(x: int, y: int) -> bool:
            for k in (x, y):
                if k not in bits:
                    bits[k] = signature(arrays[k])
            words = min(bits[x].shape[1], bits[y].shape[1])
            sizes = len(arrays[x]), len(arrays[y])
            return bool(similar(min(sizes), *sizes)) and bool(similar(most_overlap(*sizes, folded(bits[x], words)[0], folded(bits[y], words)[0]), *sizes))

        joined, out = Joined(), []
        for x, y in sorted(zip(edges["x"].tolist(), edges["y"].tolist(), strict=True)):
            if joined.root(x) != joined.root(y) and may_be(x, y) and linked(arrays[x], arrays[y]):
                joined.join(x, y)
                out.append((x, y))
        return pd.DataFrame(out, columns=["x", "y"], dtype="int64")

    links = celled.select(task, "x", "y").groupBy("task").cogroup(seated.groupBy("task")).applyInPandas(decide, "x long, y long")
    out = stash(links, "links")
    discard(label, celled)
    return out


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for the nodes of links (x, y): label is the least node reachable. Large-star and small-star by turns."""
    edges = stash(links.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct(), name)
    state = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
        # Large star: every larger neighbour of u, and u, go to the least of u and its neighbours.
        ways = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = ways.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Small star: u and its smaller neighbours go to the least of these.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("p"), F.col("a").alias("q")).unionByName(least.select(F.col("m").alias("p"), F.col("b").alias("q")))
        before, edges = edges, stash(small.where("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b")).distinct(), name)
        discard(before)
        release(links.sparkSession)  # a round shuffles all edges several times
    out = edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
    out._stashed = edges._stashed
    return out


def open_units(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(unit, node, size, band, large, label) of what must be compared in full: the large tiles that links have not joined into one.

    Tiles that overlap share most of their pairs. Where they form a cluster that takes fewer seats in pieces than its tiles do
    one by one, the cluster is the unit; otherwise each tile is.
    """
    known = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    tiles = known.groupBy("tile").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("lo <> hi")
    rows = stash(known.join(tiles.select("tile", "first", "n"), "tile").select("tile", "node", "size", "band", "large", "label", "first", "n"), "open-tiles")
    clusters = components(rows.select(F.col("first").alias("x"), F.col("node").alias("y")), "clusters").withColumnRenamed("label", "cluster")
    rows = rows.join(clusters, "node")
    seats = lambda n: F.ceil(n / TILE) * n
    one_by_one = rows.dropDuplicates(["tile"]).groupBy("cluster").agg(F.sum(seats(F.col("n"))).alias("apart"))
    at_once = clusters.groupBy("cluster").agg(seats(F.count(F.lit(1))).alias("together"))
    ways = one_by_one.join(at_once, "cluster").select("cluster", (F.col("together") <= F.col("apart")).alias("whole"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("tile", "node"), F.lit(SALTS)).cast("int")).join(ways, ["cluster", "salt"])
    unit = F.when(F.col("whole"), F.xxhash64(F.lit("cluster"), "cluster")).otherwise(F.xxhash64(F.lit("tile"), "tile"))
    return stash(rows.select(unit.alias("unit"), "node", "size", "band", "large", "label").distinct(), "open-units")


def seat_units(units: DataFrame) -> DataFrame:
    """(cell, within, side, node, label, size, large): the nodes of each cell that have another to be compared with there.

    The nodes of a unit's largest label, and the others, are dealt by size band into pieces of about TILE nodes; pieces of the
    same or the next band meet in a cell each, but not two of the largest label.
    """
    sizes = units.groupBy("unit", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("unit").agg(F.max(F.struct("n", "label"))["label"].alias("largest"))
    rows = units.join(sizes, "unit").withColumn("kind", (F.col("label") == F.col("largest")).cast("int"))
    many = rows.groupBy("unit", "band", "kind").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("pieces"))
    rows = rows.join(many, ["unit", "band", "kind"]).withColumn("piece", F.pmod(F.xxhash64("node", F.lit("piece")), F.col("pieces")))
    piece = F.struct("band", "kind", "piece")
    rows = rows.select("unit", "node", "label", "size", "large", piece.alias("piece"))
    pieces = many.select("unit", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"), "band", "kind").select("unit", piece.alias("piece"))
    one, other = pieces.select("unit", F.col("piece").alias("p")), pieces.select("unit", F.col("piece").alias("q"))
    cells = one.join(other, "unit").where("p <= q and abs(p.band - q.band) <= 1 and p.kind + q.kind < 2")
    cells = cells.select("unit", F.xxhash64("unit", "p", "q").alias("cell"), F.explode(F.array_distinct(F.array("p", "q"))).alias("piece"), (F.col("p") == F.col("q")).alias("within"))
    seated = rows.join(cells, ["unit", "piece"]).select("cell", "within", F.xxhash64("piece").alias("side"), "node", "label", "size", "large")

    return stash(seated.groupBy("cell").applyInPandas(met, seated.schema), "unit-seats")


def near_seats(seats: DataFrame, nodes: DataFrame) -> DataFrame:
    """The seats that have another to be compared with once the ranges of nodes (node, ranges) are known as well."""
    counts = nodes.join(seats.select("node").distinct(), "node", "left_semi").select("node", "ranges").dropDuplicates(["node"])
    left = seats.join(counts, "node").groupBy("cell").applyInPandas(lambda part: met(part).drop(columns="ranges"), seats.schema)
    return stash(left, "near-seats")


def met(part: pd.DataFrame) -> pd.DataFrame:
    """The rows of a cell that meet another."""
    found = np.zeros(len(part), bool)
    for i, later in meetings(part):
        found[later] = True
        found[i] |= len(later) > 0
    return part[found]


def meetings(part: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """(row, later rows) of a cell that are of different labels, and pieces if two meet, and that sizes and counts allow."""
    counts = ranged([np.frombuffer(x, np.uint8) for x in part["ranges"]]) if "ranges" in part else None
    size, large, label, side = (part[c].to_numpy() for c in ("size", "large", "label", "side"))
    size = size.astype(np.int64)
    rest, within = size - size * (100 - PERCENT) // 100 - 1, bool(part["within"].iloc[0])
    for i in range(len(part) - 1):
        k = slice(i + 1, None)
        ok = (label[k] != label[i]) & similar(np.minimum(size[i], size[k]), size[i], size[k])
        ok &= (100 + PERCENT) * (np.minimum(large[i], large[k]) + np.maximum(rest[i], rest[k])) >= PERCENT * (size[i] + size[k])
        if not within:
            ok &= side[k] != side[i]
        later = np.flatnonzero(ok) + i + 1
        if counts is not None and len(later):  # elements that differ are at least the differences of the counts
            differ = np.abs(counts[later] - counts[i]).sum(1, dtype=np.int64)
            later = later[similar((size[i] + size[later] - differ) // 2, size[i], size[later])]
        yield i, later


def compare_units(seats: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (x, y) between nodes of different labels: together with the labels they join all that the cells' similar pairs do."""
    seated = seats.join(sets.dropDuplicates(["node"]), "node")

    def decide(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        arrays = [np.frombuffer(e, "<u8") for e in part["elements"]]
        size = np.array(list(map(len, arrays)))
        node, label = part["node"].tolist(), part["label"].tolist()
        own = [signature(a) for a in arrays]
        words = min(b.shape[1] for b in own)
        bits = np.concatenate([folded(b, words) for b in own])
        joined, out = Joined(), []
        for i, later in meetings(part):
            later = later[similar(most_overlap(size[i], size[later], bits[i], bits[later]), size[i], size[later])]
            for j in later.tolist():
                if joined.root(label[i]) != joined.root(label[j]) and linked(arrays[i], arrays[j]):
                    joined.join(label[i], label[j])
                    out.append((node[i], node[j]))
        return pd.DataFrame(out, columns=["x", "y"], dtype="int64")

    return stash(seated.groupBy("cell").applyInPandas(decide, "x long, y long"), "unit-links")


def similar_nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables (doc_id, n_shingles, node, ranges) of all rows of docs(doc_id, text), node null without words, and (node, label) of the
    nodes that links join: label is the least node of the component."""
    spark = docs.sparkSession
    rows, common = document_nodes(docs)
    found = shared_shingles(docs, common)
    release(spark)
    members = tile_members(found)
    release(spark)  # the shuffle of a step may go only once another step has run
    pairs = candidates(found, members)
    discard(found)
    release(spark)
    stands = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = stash(stands.join(nodes.distinct(), "node", "left_semi"), "candidate-nodes")
        sets = candidate_sets(docs, wanted)
        discard(wanted)
        return sets

    sets = sets_of(pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))))
    release(spark)
    links = verify(pairs, sets)
    labels = components(links)
    discard(sets, pairs)
    release(spark)
    units = open_units(members, labels)
    if units.limit(1).count():
        release(spark)
        seats = seat_units(units)
        release(spark)
        near = near_seats(seats, rows.where("node is not null"))
        if near.limit(1).count():
            sets = sets_of(near.select("node"))
            labels = components(links.unionByName(compare_units(near, sets)))
            discard(sets)
        discard(near, seats)
    discard(members, units)
    release(spark)
    return rows, labels


def join_near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id, text), repeated rows included.

    component_id is the least doc_id of the documents that links reach, the row's own included; null ids are left out of
    that, and a component of null ids alone has none. A null or empty text, or one without words, has no shingles and is
    linked with nothing, not even its like. Ties need no rule: the similarity is compared in whole numbers, 0.8 itself links.
    Whole texts count, however long. Other columns are not looked at. An empty table gives an empty result.
    """
    rows, labels = similar_nodes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = nodes.groupBy("label").agg(F.min("least").alias("component_id"), F.sum("n").alias("n")).where("n > 1").drop("n")
    grouped = nodes.select("node", "label").join(least, "label").select("node", "component_id")
    return rows.join(grouped, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: of the rows with the least doc_id those with the least node, and one of them.

    Rows that share a doc_id but have different texts are settled row by row, so that an unlike text is never lost with its
    like-named one. Rows without an id, or whose text is null, empty or without words, all stay. Columns stay as they are,
    whatever their names. An empty table stays empty.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, labels = similar_nodes(slim)
    known = rows.where("node is not null and doc_id is not null").select("doc_id", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    kept = known.groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("k")).select("label", F.col("k.doc_id").alias("kept_id"), F.col("k.node").alias("kept_node"))
    ids = known.join(kept, "label").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("doc_id") == F.col("kept_id")) & (F.col("node") == F.col("kept_node"))).alias("stays"))
    ids = stash(ids.where("n > 1 or not stays"), "near-duplicate-ids")
    left = docs.join(ids, docs["doc_id"].cast("long") == ids["doc_id"], "left_anti")
    again = ids.where("n > 1")
    if not again.limit(1).count():
        return left

    @F.pandas_udf("long")
    def node_column(texts: pd.Series) -> pd.Series:
        return pd.Series([node_of(s) if len(s) else None for s in shingle_sets(texts.where(texts.notna(), None).tolist(), WordHashes())], dtype="Int64")

    held = [F.col(f"`{c}`") for c in docs.columns]
    several = docs.join(again, docs["doc_id"].cast("long") == again["doc_id"], "left_semi").select(F.struct(*held).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), node_column(F.col("text").cast("string")).alias("node"))
    wordless = several.where("node is null")
    one = several.where("node is not null").join(kept.select(F.col("kept_id").alias("doc_id"), F.col("kept_node").alias("node")), ["doc_id", "node"], "left_semi").dropDuplicates(["doc_id", "node"])
    return left.unionByName(wordless.unionByName(one).select("row.*"))

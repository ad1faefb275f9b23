"""Reductions of logits to soft labels and statistics.

A row's logits are one array; the reductions need its sorted order, so they run in NumPy on Arrow batches, a few thousand
rows at a time, and return flat columns. Ties of probability go to the lesser token id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Edges of the two edge-bucket families.
LADDER_EDGES, PAIR_EDGES = (1.0, 1e-3, 1e-6, 1e-9, 1e-12, 0.0), (1.0, 0.1, 0.0)
TINY = float(np.finfo(np.float32).tiny)


@dataclass(frozen=True)
class Reduction:
    """top_k: fixed; the dynamic one lies between least and most and covers the mass; buckets: groups of the tail by rank."""

    top_k: int = 8
    buckets: int = 4
    least: int = 1
    most: int = 32
    mass: float = 0.95


def synthetic_logits(spark: SparkSession, vocabulary: int, positions: int, factor: float = 1.0) -> DataFrame:
    """(token, position, logits) for every token and position: a deterministic teacher whose output depends on these alone."""
    ids = spark.range(vocabulary * positions).select(F.floor(F.col("id") / positions).cast("int").alias("token"), F.pmod("id", F.lit(positions)).cast("int").alias("position"))
    logit = lambda v: F.lit(factor) * (F.sin(0.13 * F.col("token") + 0.07 * F.col("position") + 0.17 * v) + F.cos(0.11 * v) + 0.001 * F.col("position"))
    return ids.withColumn("logits", F.transform(F.sequence(F.lit(0), F.lit(vocabulary - 1)), lambda v: logit(v.cast("double"))))


def softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities and log-probabilities, the latter floored at the least normal float."""
    shifted = np.exp(logits - logits.max(1, keepdims=True))
    p = shifted / shifted.sum(1, keepdims=True)
    return p, np.log(np.maximum(p, TINY))


def rank_buckets(sorted_p: np.ndarray, k: np.ndarray, buckets: int) -> np.ndarray:
    """Masses of the tail beyond each row's k, cut by rank into near-equal groups, larger ones first."""
    n, v = sorted_p.shape
    left = v - k
    base, extra = left // buckets, left % buckets
    at = np.arange(v)[None, :] - k[:, None]
    wide = (base + 1) * extra
    group = np.where(at < wide[:, None], at // np.maximum(base + 1, 1)[:, None], extra[:, None] + (at - wide[:, None]) // np.maximum(base, 1)[:, None])
    out = np.zeros((n, buckets))
    for b in range(buckets):
        out[:, b] = (sorted_p * ((at >= 0) & (group == b))).sum(1)
    return out


def edge_buckets(p: np.ndarray, logp: np.ndarray, tail: np.ndarray, edges: tuple[float, ...], upper_closed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mass, count and mean log-probability of the tail between falling edges. upper_closed: low < p <= high, the last bucket
    with its low edge; else low <= p < high."""
    mass, count, mean = (np.zeros((len(p), len(edges) - 1)) for _ in range(3))
    for b, (high, low) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if upper_closed:
            own = tail & (p <= high) & ((p >= low) if b == len(edges) - 2 else (p > low))
        else:
            own = tail & (p < high) & (p >= low)
        count[:, b], mass[:, b] = own.sum(1), (p * own).sum(1)
        mean[:, b] = (logp * own).sum(1) / np.maximum(count[:, b], 1)
    return mass, count.astype(np.int64), mean


def reduce_rows(logits: np.ndarray, spec: Reduction) -> dict[str, np.ndarray]:
    """All reductions of a batch of equally long rows."""
    p, logp = softmax(logits)
    n, v = p.shape
    order = np.argsort(-p, 1, kind="stable")
    sp = np.take_along_axis(p, order, 1)
    cumulative = np.cumsum(sp, 1)
    most = min(spec.most, v)
    hit = cumulative >= spec.mass
    reached = np.where(hit.any(1), hit.argmax(1) + 1, most)
    dynamic = np.clip(reached, min(spec.least, most), most)
    k = min(spec.top_k, v)
    top = np.zeros((n, v), bool)
    np.put_along_axis(top, order[:, :k], True, 1)
    rows = np.arange(n)
    pick = lambda d: cumulative[:, min(d, v) - 1]
    out = {
        "entropy": -(p * logp).sum(1), "top_token": order[:, 0], "confidence": sp[:, 0], "top1_margin": np.maximum(sp[:, 0] - (sp[:, 1] if v > 1 else 0), 0), "top8_mass": np.clip(pick(8), 0, 1),
        "top32_mass": np.clip(pick(32), 0, 1), "top_ids": order[:, :k], "top_probs": sp[:, :k], "top_mass": pick(k), "tail_mass": np.clip(1 - pick(k), 0, 1),
        "rank_bucket_mass": rank_buckets(sp, np.full(n, k), spec.buckets), "dynamic_k": dynamic, "dynamic_mass": cumulative[rows, dynamic - 1],
        "dynamic_tail": np.clip(1 - cumulative[rows, dynamic - 1], 0, 1), "dynamic_bucket_mass": rank_buckets(sp, dynamic, spec.buckets),
    }
    out["stat_tail_mass"] = np.maximum(1 - out["top32_mass"], 0)
    for name, edges, closed in (("pair", PAIR_EDGES, True), ("ladder", LADDER_EDGES, False)):
        for kind, x in zip(("mass", "count", "logp"), edge_buckets(p, logp, ~top, edges, closed), strict=True):
            out[f"{name}_{kind}"] = x
    return out


INTS = ("top_token", "dynamic_k")
LISTS = {"top_ids": "int", "top_probs": "double", "rank_bucket_mass": "double", "dynamic_bucket_mass": "double"} | {f"{n}_{k}": "long" if k == "count" else "double" for n in ("pair", "ladder") for k in ("mass", "count", "logp")}
SCALARS = ("entropy", "confidence", "top1_margin", "top8_mass", "top32_mass", "top_mass", "tail_mass", "dynamic_mass", "dynamic_tail", "stat_tail_mass")


def reduce_logits(rows: DataFrame, spec: Reduction = Reduction(), stats: bool = True) -> DataFrame:
    """rows(..., logits array<double>) with the logits replaced by their reductions. With stats, fewer than 32 entries a row
    are an error: the statistics need that depth."""
    keys = [c for c in rows.columns if c != "logits"]
    fields = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys] + [f"{c} double" for c in SCALARS] + [f"{c} int" for c in INTS] + [f"{c} array<{t}>" for c, t in LISTS.items()]
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            arrays = batch.column(len(keys))
            widths = np.diff(np.asarray(arrays.offsets))
            if len(set(widths.tolist())) > 1:
                raise ValueError("rows of one table must have equally many logits")
            width = int(widths[0])
            if stats and width < 32:
                raise ValueError("corridor statistics need 32 probabilities or more")
            flat = np.asarray(arrays.flatten()).reshape(-1, width)
            for a in range(0, len(flat), max(1, 4_000_000 // width)):
                part = flat[a : a + max(1, 4_000_000 // width)]
                got = reduce_rows(part, spec)
                columns = [batch.column(k).slice(a, len(part)) for k in range(len(keys))] + [pa.array(got[c]) for c in SCALARS] + [pa.array(got[c].astype(np.int32)) for c in INTS]
                for c, t in LISTS.items():
                    x = got[c].astype({"int": np.int32, "long": np.int64, "double": np.float64}[t])
                    columns.append(pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel(), kinds[t])))
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, *SCALARS, *INTS, *LISTS])

    return rows.select(*keys, "logits").mapInArrow(work, ", ".join(fields))

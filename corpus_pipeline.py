"""The corpus pipeline over `documents`: quality, near duplicates, benchmark decontamination, secrets, packing.

Each stage works on all that its predecessor kept and returns the columns of `documents`; the last returns the packed pieces.
A stage's result is written as Parquet in the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm import decontam, gam, jaccard, packing, secrets
from quillwork.llm.queries import table, tokenizer_path
from quillwork.llm.shared import stash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the additive model, learnt from the labels, scores at its threshold or above; null and empty texts are scored
    too. The score's name steps aside for any column of docs, whatever its case. An empty table stays empty."""
    model = gam.train(docs, table(spark, sf_dir, "labels"))
    name, taken = "quality_score", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return gam.score(docs, model, name=name).where(F.col(name) >= gam.THRESHOLD).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least doc_id. Rows without an id or without words stay."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy, exact or edited, of a benchmark item; null and empty texts hold none."""
    return decontam.drop_copies(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind, n_chars brought up to date; null and empty texts stay as they are."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces with their places in sequences of 2048 tokens; a null text is empty, and has its end."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", redaction), ("packing", packed)]

#: SQL can't express these stages; tests/llm runs them in order over a small folder with planted copies, leaks and junk, and
#: compares near duplicates and packing with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; the packed pieces of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stash(docs, f"pipeline-{name}")
    return docs

"""The queries of this package, one an operator, over whole tables; __spark_entry__.py registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm import decontam, gam, hpylm, html_crf, jaccard, packing, rules, secrets, urls, warc
from quillwork.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score_texts(table(spark, sf_dir, "documents"))


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_near_duplicates(table(spark, sf_dir, "documents"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    trusted, others = (labels.where(x).select("doc_id") for x in ("quality = 1 and toxic = 0", "quality = 0 or toxic = 1"))
    return rules.judge_quality(table(spark, sf_dir, "documents"), trusted, others)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.fresh_folder(spark)
    index = warc.write_bundles(table(spark, sf_dir, "pages"), folder)
    return warc.read_bundles(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_lm": op2_lm,
    "op3_decontam": op3_decontam,
    "op4_quality": op4_quality,
    "op5_pack": op5_pack,
    "op6_jaccard": op6_jaccard,
    "op7_rules": op7_rules,
    "op8_warc": op8_warc,
    "op9_urls": op9_urls,
    "op10_extract": op10_extract,
}
ORACLE_SQL: dict[str, str] = {
    "op8_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
            FROM pages
        )
        SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM p
    """,
}

"""URL filter: host and path rules, else a character language-model ratio. DataFrame functions only.

Two smoothed variable-order Markov models over characters (Witten-Bell interpolation from the longest
context down to a uniform base) are counted over all URLs that the rules accept and reject: the whole URL, its host in lower
case, as often as it occurs. A URL that no rule decides is judged by the difference of its log-likelihoods per character against a threshold
calibrated on a fifth of the rule-decided URLs that the models do not count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.shared import ascii_lower, stash

#: Copies of the gram table that a hot gram is dealt over.
SALTS = 16
FOLDS = 5


@dataclass(frozen=True)
class UrlRules:
    """(host, path) pairs as strings like 'example.com/en/7'."""

    block: tuple[str, ...] = ("com/en/", "example.net/de/8", "org/es/")
    allow: tuple[str, ...] = ("example.com/en/7", "net/de/")
    order: int = 4
    all: tuple[tuple[str, str], ...] = field(init=False)

    def __post_init__(self):
        rules = [(r, "block") for r in self.block] + [(r, "allow") for r in self.allow]
        object.__setattr__(self, "all", tuple(sorted(rules, key=lambda r: (-len(r[0]), r[0]))))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def whole(url: Column) -> Column:
    """The URL with A-Z of its host lower-cased; empty for null."""
    at, host = F.locate("://", url), F.regexp_extract(url, "://([^/?#]*)", 1)
    lowered = F.concat(F.substr(url, F.lit(1), at + 2), ascii_lower(host), F.substr(url, at + 3 + F.length(host)))
    return F.coalesce(F.when(at > 0, lowered).otherwise(url), F.lit(""))


def _by_rule(rules: UrlRules, host: Column, path: Column, value) -> Column:
    out = F.lit(None).cast("string")
    for rule, verdict in reversed(rules.all):
        own, cut, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(cut + rest)
        out = F.when(fits, F.lit(value(rule, verdict))).otherwise(out)
    return out


def _fold() -> Column:
    """One in FOLDS of the rule-decided texts is not counted: the threshold is calibrated on these."""
    return F.pmod(F.xxhash64("text"), F.lit(FOLDS))


def gram_ratios(texts: DataFrame, order: int) -> DataFrame:
    """texts: distinct (text, verdict of a rule or null, n rows of it). Returns (gram, llr): log P(accepted) - log P(rejected) of the
    last character of each gram of `order` characters after the others."""
    padded = F.concat(F.lit("\u0002" * (order - 1)), "text", F.lit("\u0003"))
    grams = texts.select(F.when(_fold() != 0, F.col("verdict")).alias("verdict"), "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") + 1), lambda i: F.substr(padded, i, F.lit(order)))).alias("gram"))
    counted = grams.groupBy("gram").agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("r")
    )
    counted = stash(counted, "url-grams")
    alphabet = counted.select(F.substr("gram", F.lit(order), F.lit(1)).alias("c")).distinct().count() + 1
    out = counted.select("gram", F.lit(1.0 / alphabet).alias("pa"), F.lit(1.0 / alphabet).alias("pr"))
    for n in range(1, order + 1):
        tail = counted.groupBy(F.substr("gram", F.lit(order - n + 1), F.lit(n)).alias(f"tail{n}")).agg(F.sum("a").alias(f"gram_a{n}"), F.sum("r").alias(f"gram_r{n}"))
        ctx = tail.groupBy(F.substr(f"tail{n}", F.lit(1), F.lit(n - 1)).alias(f"ctx{n}")).agg(
            *(f(k) for k in "ar" for f in (lambda k: F.sum(f"gram_{k}{n}").alias(f"total_{k}{n}"), lambda k: F.sum((F.col(f"gram_{k}{n}") > 0).cast("int")).alias(f"kinds_{k}{n}")))
        )
        out = out.withColumn(f"tail{n}", F.substr("gram", F.lit(order - n + 1), F.lit(n))).withColumn(f"ctx{n}", F.substr("gram", F.lit(order - n + 1), F.lit(n - 1)))
        out = out.join(tail, f"tail{n}").join(ctx, f"ctx{n}")
        for k in "ar":
            seen = F.col(f"total_{k}{n}") > 0
            out = out.withColumn(f"p{k}", F.when(seen, (F.col(f"gram_{k}{n}") + F.col(f"kinds_{k}{n}") * F.col(f"p{k}")) / (F.col(f"total_{k}{n}") + F.col(f"kinds_{k}{n}"))).otherwise(F.col(f"p{k}")))
        out = out.select("gram", "pa", "pr")
    return out.select("gram", (F.log("pa") - F.log("pr")).alias("llr"))


def judge_urls(pages: DataFrame, rules: UrlRules = UrlRules(), url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, score) for every row, repeated rows included.

    A null URL or one without '://' has an empty host and path and no rule; the latter is scored as it stands, a null one as
    an empty text. Host and path are for the rules alone, the models read the whole URL. Empty tables give empty results. Where the rules leave one of the two classes without a URL to
    calibrate on, every other URL is allowed.
    score: the log-likelihood ratio a character, less the calibrated threshold; null where a rule decides.
    """
    rows = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), whole(F.col(url)).alias("text"))
    rows = rows.withColumn("rule", _by_rule(rules, F.col("host"), F.col("path"), lambda r, v: r)).withColumn("fixed", _by_rule(rules, F.col("host"), F.col("path"), lambda r, v: v))
    # A distinct text has one host and path, so it has one verdict.
    texts = stash(rows.groupBy("text").agg(F.max("fixed").alias("verdict"), F.count(F.lit(1)).alias("n")), "url-texts")
    ratios = gram_ratios(texts, rules.order)
    padded = F.concat(F.lit("\u0002" * (rules.order - 1)), "text", F.lit("\u0003"))
    at = texts.select("text", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") + 1), lambda i: F.substr(padded, i, F.lit(rules.order)))).alias("gram"))
    at = at.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    ratios = ratios.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Merge joins: the estimate from the compressed table is far too low for the exploded side to be broadcast safely.
    scored = at.join(ratios.hint("merge"), ["gram", "salt"]).groupBy("text").agg(F.round(F.sum("llr") / F.count(F.lit(1)), 9).alias("ratio"))
    scored = stash(scored.join(texts, "text"), "url-scores")
    mean = F.sum(F.col("n") * F.col("ratio")) / F.sum("n")
    seen = {r["verdict"]: r for r in scored.where(F.col("verdict").isNotNull() & (_fold() == 0)).groupBy("verdict").agg(mean.alias("m"), F.sqrt(F.greatest(F.sum(F.col("n") * F.col("ratio") ** 2) / F.sum("n") - mean**2, F.lit(0.0))).alias("s")).collect()}
    if "allow" in seen and "block" in seen:
        a, b = seen["allow"], seen["block"]
        spread = a["s"] + b["s"]
        cut = (a["m"] * b["s"] + b["m"] * a["s"]) / spread if spread else (a["m"] + b["m"]) / 2
        cut = round(cut, 9)
        by_model = F.when(F.col("ratio") >= cut, F.lit("allow")).otherwise(F.lit("block"))
    else:
        cut, by_model = 0.0, F.lit("allow")
    out = rows.join(scored.select("text", "ratio").hint("merge"), "text", "left")
    return out.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce(F.col("fixed"), by_model).alias("verdict"), F.when(F.col("fixed").isNull(), F.round(F.col("ratio") - cut, 9)).alias("score")
    )

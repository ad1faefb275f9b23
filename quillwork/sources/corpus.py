"""Readers of source files, JSON lines and prompt corpora, with explicit schemas."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes that are read, and folders that are left out.
SUFFIXES = (".txt", ".md", ".markdown", ".py", ".jsonl")
LEFT_OUT = (".git", "__pycache__", ".venv", "node_modules", ".pytest_cache")
PROMPT = "id string, text string, split string, tags array<string>, metadata map<string,string>"


def glob_pattern(glob: str) -> str:
    """A regular expression for the relative paths that a glob takes: as a whole, stars crossing folders, or its last parts one
    by one. A leading **/ may also stand for no folder."""
    whole = lambda g: fnmatch.translate(g).replace("\\Z", "\\z")
    found = []
    for g in dict.fromkeys((glob, glob.removeprefix("**/"))):
        parts = [fnmatch_part(x) for x in g.split("/") if x]
        found += [whole(g), "(?s:(?:.*/)?" + "/".join(parts) + ")\\z"]
    return "(?:" + "|".join(f"^{x}" for x in found) + ")"


def fnmatch_part(part: str) -> str:
    """One path component: stars and question marks stay within it."""
    out = []
    for piece in re.split(r"(\*+|\?|\[[^\]]+\])", part):
        if piece.startswith("*"):
            out.append("[^/]*")
        elif piece == "?":
            out.append("[^/]")
        elif piece.startswith("[") and piece.endswith("]"):
            out.append("[^" + piece[2:] if piece[1] == "!" else piece)
        else:
            out.append(re.escape(piece))
    return "".join(out)


def excluded_reason(path: Column, relative: Column, include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> Column:
    """The first reason that bars a file, in order: its folder, an exclusion, its suffix, no inclusion; else null."""
    glob = lambda g: relative.rlike(glob_pattern(g))
    folder = F.exists(F.slice(F.split(relative, "/"), 1, F.greatest(F.size(F.split(relative, "/")) - 1, F.lit(1))), lambda p: p.isin(*LEFT_OUT)) & relative.contains("/")
    reason = F.when(folder, "default_exclude")
    for g in exclude:
        reason = reason.when(glob(g), "exclude_glob")
    suffix = F.lower(F.regexp_extract(relative, r"(\.[^./]+)\z", 1))
    reason = reason.when(~suffix.isin(*SUFFIXES), "unsupported_suffix")
    if include:
        hit = F.lit(False)
        for g in include:
            hit = hit | glob(g)
        reason = reason.when(~hit, "include_glob_miss")
    return reason


def discover(spark: SparkSession, root: str, include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> DataFrame:
    """(path, relative, size, content, reason) of all files under a folder; a NUL among the first 4,096 bytes marks a binary file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.split("://", 1)[-1].rstrip("/") + "/"
    relative = F.substring_index(F.col("path"), base, -1)
    reason = excluded_reason(F.col("path"), relative, include, exclude)
    binary = F.instr(F.hex(F.substring("content", 1, 4096)), "00") > 0
    nul = F.exists(F.sequence(F.lit(1), F.least(F.lit(4096), F.greatest(F.octet_length("content"), F.lit(1)))), lambda k: F.hex(F.substring(F.col("content"), k, F.lit(1))) == "00")
    return files.select("path", relative.alias("relative"), F.col("length").alias("size"), "content", F.coalesce(reason, F.when(binary & nul, "binary_file")).alias("reason"))


def read_documents(files: DataFrame) -> DataFrame:
    """(relative, line, text): a text file is one document, a JSON-lines file one a line with a string `text`; lines with none, or
    one of another type, give none. A blank line is passed over; one that isn't a JSON object stops the read and is named. A
    file that isn't UTF-8 gives none."""
    kept = files.where(F.col("reason").isNull())
    whole = kept.withColumn("text", F.try_validate_utf8(F.col("content").cast("string"))).where(F.col("text").isNotNull())
    lines = F.col("relative").endswith(".jsonl")
    single = whole.where(~lines).select("relative", F.lit(0).alias("line"), "text")
    many = whole.where(lines).select("relative", F.posexplode(F.split("text", "\n")).alias("line", "json"))
    return single.unionByName(many.where(r"json rlike '\\S'").select("relative", "line", object_text(F.col("relative"), F.col("line")).alias("text")).where("text is not null"))


def object_text(file: Column, line: Column) -> Column:
    """The string `text` of the JSON object in column `json`; null without one. line counts from 0."""
    parsed = F.try_parse_json("json")
    found = F.try_variant_get(parsed, "$.text", "variant")
    wrong = F.raise_error(F.concat(file, F.lit(":"), (line + 1).cast("string"), F.lit(" must be a JSON object")))
    ok = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(~ok, wrong).when(F.schema_of_variant(found) == "STRING", F.try_variant_get(parsed, "$.text", "string"))


#: What ends a line, as Python's splitlines takes it.
LINE_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """(example_id, text) of the JSON lines of each file; a row without an id is example-{line}, counted from 1 with blank lines.
    A line without a string `text` stops the read and is named."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", LINE_ENDS)).alias("line", "json")).where(r"json rlike '\\S'")
    number, parsed = (F.col("line") + 1).cast("string"), F.try_parse_json("json")
    text = F.when(F.schema_of_variant(F.try_variant_get(parsed, "$.text", "variant")) == "STRING", F.try_variant_get(parsed, "$.text", "string"))
    text = F.coalesce(text, F.raise_error(F.concat(F.lit("line "), number, F.lit(" must contain string field text"))))
    return lines.select(F.coalesce(F.try_variant_get(parsed, "$.example_id", "string"), F.concat(F.lit("example-"), number)).alias("example_id"), text.alias("text"))


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompt rows; a row that doesn't fit the schema stops the read."""
    return spark.read.schema(PROMPT).option("mode", "FAILFAST").json(path)


def check_prompts(prompts: DataFrame) -> DataFrame:
    """(id, reason) of rows without id or text, and of ids that stand twice."""
    empty = prompts.where(F.col("id").isNull() | (F.col("id") == "")).select("id", F.lit("id_missing").alias("reason"))
    blank = prompts.where(F.col("text").isNull() | (F.trim("text") == "")).select("id", F.lit("text_empty").alias("reason"))
    twice = prompts.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit("id_duplicate").alias("reason"))
    return empty.unionByName(blank).unionByName(twice)


def write_prompts(prompts: DataFrame, path: str) -> None:
    """JSON lines; an existing target is an error."""
    prompts.select("id", "metadata", "split", "tags", "text").write.mode("errorifexists").json(path)

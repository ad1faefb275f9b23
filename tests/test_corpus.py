from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillwork.functions import text as T
from quillwork.operators import corpus
from quillwork.sources import corpus as sources


def docs(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")


def test_two_texts_cut_in_three_letter_windows(spark):
    chunks = corpus.chunk_documents(docs(spark, ["abcdef", "abcdef"]), 3)
    kept = corpus.contiguous_ids(corpus.drop_duplicates(chunks), ("doc_id", "chunk_index"), F.floor(F.col("doc_id") / 4096))
    rows = kept.select(corpus.corpus_id(F.col("ord")), "text", "chunk_count", "doc_id").collect()
    assert sorted(map(tuple, rows)) == [("corpus_000000001", "abc", 2, 0), ("corpus_000000002", "def", 2, 0)]
    assert chunks.count() - kept.count() == 2


def plain(text: str) -> str:
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return "\n".join(x.rstrip() for x in lines).strip()


def test_normalisation_against_str_methods(spark):
    rng = random.Random(11)
    pool = list("ab \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u2028\u3000") + ["\r\n", "é"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    got = docs(spark, texts).select("doc_id", T.normalize(F.col("text")).alias("t")).collect()
    # str.splitlines isn't used: only CR and LF end lines.
    assert {r["doc_id"]: r["t"] for r in got} == {k: plain(t) for k, t in enumerate(texts)}


def test_windows_strip_and_drop(spark):
    got = docs(spark, ["abc   def", "  ", None, "ünï" * 3, "short"]).select("doc_id", T.windows(T.normalize(F.col("text")), 4).alias("w")).collect()
    assert {r["doc_id"]: r["w"] for r in got} == {0: ["abc", "de", "f"], 1: [], 2: [], 3: ["ünïü", "nïün", "ï"], 4: ["shor", "t"]}


def test_contiguous_ids_across_bins(spark):
    rows = spark.range(0, 5000, 7).withColumnRenamed("id", "doc_id").repartition(5)
    got = corpus.contiguous_ids(rows, ("doc_id",), F.floor(F.col("doc_id") / 512)).orderBy("doc_id").select("ord").collect()
    assert [r["ord"] for r in got] == list(range(1, len(got) + 1))


def test_duplicates_keep_the_first_under_any_partitioning(spark):
    chunks = corpus.chunk_documents(docs(spark, ["x y", "z", "x y", "x y", "z"]), 100)
    for n in (1, 4):
        assert sorted(r["doc_id"] for r in corpus.drop_duplicates(chunks.repartition(n)).collect()) == [0, 1]


def test_largest_remainder(spark):
    rows = spark.createDataFrame([(k, s) for k, s in enumerate("aaaaabbbc")], "id int, s string")
    got = corpus.stratified_sample(rows, "s", ("id",), 4).orderBy("id").collect()
    assert [(r["s"], r["id"]) for r in got] == [("a", 0), ("a", 1), ("b", 5), ("c", 8)]


def test_seeded_split_sizes_and_stability(spark):
    rows = spark.range(100).withColumn("id", F.col("id").cast("string"))
    one = {r["id"]: r["split"] for r in corpus.seeded_split(rows, 0.1, 0.2, 5).collect()}
    two = {r["id"]: r["split"] for r in corpus.seeded_split(rows.repartition(7), 0.1, 0.2, 5).collect()}
    assert one == two and [list(one.values()).count(s) for s in ("train", "validation", "test")] == [70, 10, 20]
    tiny = [r["split"] for r in corpus.seeded_split(rows.limit(2), 0.01, 0.9, 5).collect()]
    assert sorted(tiny) == ["test", "train"]


def test_byte_and_codepoint_tokens(spark):
    rows = corpus.byte_tokens(docs(spark, ["aé", None])).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {0: [98, 196, 170], 1: []}
    got = docs(spark, ["a😀"]).select(corpus.group_tokens(F.col("text"), 4, 100).alias("t")).first()["t"]
    assert got == [97, (128512 + 1) % 100, 0, 0]


def test_sources_are_discovered_with_reasons(spark, tmp_path):
    (tmp_path / "node_modules").mkdir()
    for name, data in {"a.txt": b"hello", "b.bin": b"x", "c.md": b"a\0b", "d.jsonl": b'{"text": "one"}\n{"other": 1}\n{"text": "two"}', "e.txt": b"\xff\xfe", "node_modules/x.txt": b"n", "skip.txt": b"s"}.items():
        (tmp_path / name).write_bytes(data)
    files = sources.discover(spark, str(tmp_path), exclude=("skip*",))
    assert {r["relative"]: r["reason"] for r in files.collect()} == {"a.txt": None, "b.bin": "unsupported_suffix", "c.md": "binary_file", "d.jsonl": None, "e.txt": None, "node_modules/x.txt": "default_exclude", "skip.txt": "exclude_glob"}
    assert sorted((r["relative"], r["line"], r["text"]) for r in sources.read_documents(files).collect()) == [("a.txt", 0, "hello"), ("d.jsonl", 0, "one"), ("d.jsonl", 2, "two")]


def test_prompts_round_trip_and_checks(spark, tmp_path):
    rows = spark.createDataFrame([("p0", "hi", "val", ["a", "b"], {"k": "v"}), ("p1", "yo", "train", ["a"], None), ("p1", " ", "train", [], None)], sources.PROMPT)
    assert sorted(r["reason"] for r in sources.check_prompts(rows).collect()) == ["id_duplicate", "text_empty"]
    sources.write_prompts(rows, f"{tmp_path}/p")
    back = sources.read_prompts(spark, f"{tmp_path}/p")
    assert corpus.filter_prompts(back.withColumn("ord", F.col("id")), tags=("a", "b")).count() == 1
    with pytest.raises(Exception, match="already exists"):
        sources.write_prompts(rows, f"{tmp_path}/p")


def test_short_chunks_go_after_they_are_numbered(spark):
    rows = corpus.chunk_documents(docs(spark, ["abcd  e fghi"]), 4, 4).select("text", "chunk_index", "chunk_count").collect()
    assert sorted(map(tuple, rows)) == [("abcd", 0, 3), ("fghi", 2, 3)]


def test_globs_match_whole_paths_and_last_parts(spark):
    from quillwork.sources import corpus as source

    paths = ["a.md", "x/a.md", "x/y/a.md", "x/y/b.txt", "docs/z.md", "q/docs/z.md"]
    table = spark.createDataFrame([(p,) for p in paths], "p string")
    hit = lambda g: [r["p"] for r in table.where(F.col("p").rlike(source.glob_pattern(g))).collect()]
    assert hit("**/*.md") == [p for p in paths if p.endswith(".md")]
    assert hit("docs/*.md") == ["docs/z.md", "q/docs/z.md"] and hit("y/?.txt") == ["x/y/b.txt"] and hit("[ab].md") == paths[:3] and hit("a") == []


def test_json_lines_take_string_texts_and_name_bad_lines(spark, tmp_path):
    from quillwork.sources import corpus as source

    (tmp_path / "a.jsonl").write_text('{"text": "one"}\n\n{"text": 5}\n{"id": 1}\n  \n{"text": "two"}\n')
    got = source.read_documents(source.discover(spark, str(tmp_path))).collect()
    assert sorted((r["line"], r["text"]) for r in got) == [(0, "one"), (5, "two")]
    for bad in ('{"text": ', "[1]"):
        (tmp_path / "a.jsonl").write_text('{"text": "one"}\n' + bad + "\n")
        with pytest.raises(Exception, match="a.jsonl:2 must be a JSON object"):
            source.read_documents(source.discover(spark, str(tmp_path))).collect()


def test_examples_have_default_ids(spark, tmp_path):
    from quillwork.sources import corpus as source

    (tmp_path / "e.jsonl").write_text('{"text": "one"}\n\n{"text": "two", "example_id": 7}\n{"text": "three", "example_id": "x"}\n')
    assert sorted(map(tuple, source.read_examples(spark, str(tmp_path / "e.jsonl")).collect())) == [("7", "two"), ("example-1", "one"), ("x", "three")]
    (tmp_path / "e.jsonl").write_text('{"text": "one"}\n{"text": null}\n')
    with pytest.raises(Exception, match="line 2 must contain string field text"):
        source.read_examples(spark, str(tmp_path / "e.jsonl")).collect()

from __future__ import annotations

import sys
from pathlib import Path

import pandas as pd

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as fx  # noqa: E402


def test_stages_in_order_over_a_small_folder(spark, tmp_path):
    import corpus_pipeline

    rows = fx.rows()
    fx.table(spark, partitions=2).write.parquet(f"{tmp_path}/documents.parquet")
    pd.DataFrame([(k, 1, 0) for k in range(40)] + [(k, 1, 0) for k in range(100, 125)] + [(140, 0, 0), (141, 0, 0)], columns=["doc_id", "quality", "toxic"]).to_parquet(f"{tmp_path}/labels.parquet")
    leak = next(t for i, t, *_ in rows if i == 7)
    pd.DataFrame([(1, leak)], columns=["item_id", "text"]).to_parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == columns
        ids.append({r["doc_id"] for r in docs.collect()})
    assert not {140, 141} & ids[0] and set(range(40)) <= ids[0]
    assert ids[1] & set(range(100, 123)) <= {100, 121} and 7 in ids[1] and 7 not in ids[2] and ids[2] == ids[3] == ids[4]
    assert ids[1] - ids[2] == {7}
    final = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(map(str, final)) == sorted(map(str, docs.select("doc_id", "piece", "ids_crc32").collect()))


def test_stages_take_empty_tables_and_clashing_names(spark, tmp_path):
    import corpus_pipeline

    pd.DataFrame([(k, k % 2, 0) for k in range(8)], columns=["doc_id", "quality", "toxic"]).to_parquet(f"{tmp_path}/labels.parquet")
    pd.DataFrame([(1, "a leaked line of a benchmark item")], columns=["item_id", "text"]).to_parquet(f"{tmp_path}/benchmark.parquet")
    docs = fx.empty(spark).withColumnRenamed("score", "QUALITY_SCORE")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_entry_registers_every_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert any(k.startswith(f"op{n}_") for k in names)
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)

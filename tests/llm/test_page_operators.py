from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quillwork.llm import html_crf, urls, warc

SCHEMA = "page_id long, url string, html string, text string, host string, same string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "t", "h", "s") for r in rows], SCHEMA)


LONG = "<html>" + "x" * 1200
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, LONG), (4, "http://b", "short"), (5, "http://b", "short"), (6, "u\r\nv", None), (7, "", ""), (None, "http://n", LONG), (3, None, LONG), (8, "http://z", "ü" * 600)]


def test_warc_round_trip(spark, tmp_path):
    folder = f"file://{tmp_path}"
    index = warc.write_bundles(pages(spark, ROWS).repartition(2), folder, frame_bytes=3000, bundle_bytes=2500)
    got = warc.read_bundles(index, folder, keep_payload=True).collect()
    assert len(got) == len(ROWS) == index.count()
    for r in got:
        html = next(h or "" for i, _, h in ROWS if i == r["page_id"])
        data = html.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == data
    revisits = sorted((r["page_id"] is None, r["page_id"], r["refers_to"]) for r in got if r["record_type"] == "revisit")
    assert revisits == [(False, 1, 3), (False, 2, 3), (True, None, 3)]
    some = index.where("page_id in (4, 8)")
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in warc.fetch_records(some, folder).collect()) == [(4, "short"), (8, "ü" * 600)]
    assert warc.write_bundles(pages(spark, []), folder).count() == 0


def test_records_have_ids_of_their_own(spark, tmp_path):
    folder = f"file://{tmp_path}"
    index = warc.write_bundles(pages(spark, ROWS + ROWS[3:5] * 40 + ROWS[:3]).repartition(3), folder, frame_bytes=3000).collect()
    assert len({r["record_id"] for r in index}) == len(index) == len(ROWS) + 83
    full, named = set(), set()
    for r in index:
        with warc.opened(folder, r["bundle"], False) as file:
            record = warc.BundleReader(file).frame(r["frame"])[r["start"] : r["start"] + r["length"]]
        assert f"WARC-Record-ID: <{r['record_id']}>".encode() in record
        to = re.search(rb"WARC-Refers-To: <([^>]+)>", record)
        (named.add(to[1].decode()) if to else full.add(r["record_id"]))
    assert len(named) == 1 and named <= full  # the one repeated payload of 1,000 bytes or more


def test_each_bundle_is_read_by_a_task_of_its_own(spark, tmp_path):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as many bundles as a hash exchange has partitions
    folder = f"file://{tmp_path}"
    index = warc.write_bundles(pages(spark, [(k, f"http://{k}", "x" * 2000 + str(k)) for k in range(200)]).repartition(parts), folder)
    got = warc.read_bundles(index, folder).withColumn("task", F.spark_partition_id())
    assert index.select("bundle").distinct().count() == parts == got.select("task").distinct().count() and got.count() == 200


def test_bundles_seek_by_their_table(tmp_path):
    writer = warc.BundleWriter(warc.opened(str(tmp_path), "b.zst", True), 100)
    places = [writer.add(bytes([k]) * 60) for k in range(7)]
    writer.close()
    with warc.opened(str(tmp_path), "b.zst", False) as f:
        reader = warc.BundleReader(f)
        for k, (frame, start, length) in reversed(list(enumerate(places))):
            assert reader.frame(frame)[start : start + length] == bytes([k]) * 60
    import zstandard

    plain = zstandard.ZstdDecompressor().stream_reader((tmp_path / "b.zst").open("rb"), read_across_frames=True).read()
    assert len(plain) == 420  # any Zstandard reader passes over the table


def test_url_rules_longest_wins(spark):
    rows = [(1, "http://x.com/en/1"), (2, "http://example.com/en/7x"), (3, "http://a.Example.COM/en/7?q"), (4, "http://example.net/de/8"), (5, "http://m.example.net/de/9#f"), (6, "http://o.org/es/"), (7, None), (8, "no scheme"), (9, "http://notexample.com/en/7"), (10, "http://com/en/")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages(spark, [(i, u, "") for i, u in rows])).collect()}
    want = {1: "com/en/", 2: "example.com/en/7", 3: "example.com/en/7", 4: "example.net/de/8", 5: "net/de/", 6: "org/es/", 7: None, 8: None, 9: "com/en/", 10: "com/en/"}
    assert {k: v[2] for k, v in got.items()} == want
    assert got[3][:2] == ("a.example.com", "/en/7") and got[7][:2] == ("", "") and got[5][3] == "allow" and got[4][3] == "block"
    assert urls.judge_urls(pages(spark, [])).count() == 0


def test_url_model_tells_kinds_apart(spark):
    rng = random.Random(4)
    word = lambda a: "".join(rng.choice(a) for _ in range(8))
    rows = [(k, f"http://{word('abcdef')}.net/de/{word('abcdef')}", "") for k in range(300)] + [(1000 + k, f"http://{word('uvwxyz')}.com/en/{word('uvwxyz')}", "") for k in range(300)]
    rows += [(2000 + k, f"http://{word('abcdef')}.info/{word('abcdef')}", "") for k in range(50)] + [(3000 + k, f"http://{word('uvwxyz')}.info/{word('uvwxyz')}", "") for k in range(50)]
    rows += [rows[-1]] * 3
    got = urls.judge_urls(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    open_ = [(r["page_id"], r["verdict"]) for r in got if r["page_id"] >= 2000]
    assert sum((v == "allow") == (i < 3000) for i, v in open_) / len(open_) > 0.95
    plan = urls.judge_urls(pages(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_model_reads_the_whole_url_of_every_row(spark):
    rng = random.Random(6)
    word = lambda a: "".join(rng.choice(a) for _ in range(8))
    rows = [(k, f"http://{word('abcdef')}.net/de/?q={word('ghijk')}", "") for k in range(200)] + [(1000 + k, f"http://{word('abcdef')}.com/en/?q={word('uvwxyz')}", "") for k in range(200)]
    rows += [(2000, "http://abc.info/a?q=ghijkghijk", ""), (2001, "http://abc.info/a?q=uvwxyzuvwxyz", ""), (2002, "ghijk", ""), (2003, "uvwxyz", ""), (2004, "http://ABC.info/a?q=ghijkghijk", ""), (2005, "http://abc.info/a#uvwxyz", "")]
    got = {r["page_id"]: r for r in urls.judge_urls(pages(spark, rows)).collect()}
    assert got[2000]["verdict"] == "allow" and got[2001]["verdict"] == "block" and got[2002]["score"] > got[2003]["score"]
    assert got[2000]["score"] == got[2004]["score"] and got[2005]["score"] < got[2000]["score"]
    again = {r["page_id"]: r for r in urls.judge_urls(pages(spark, rows + rows[:40] * 9)).collect()}
    assert again[2000]["score"] != got[2000]["score"]


def test_leaf_blocks_of_odd_pages():
    text = lambda h: [b.text() for b in html_crf.leaf_blocks(h)]
    assert text("<p>a<b>b</b>c<p>d<br>e<script>x='<p>'</script>f") == ["abc", "d e", "f"] or text("<p>a<b>b</b>c<p>d<br>e") == ["abc", "d e"]
    assert text("<ul><li>a<li>b</ul>c<!-- <p>x -->&lt;p&gt;") == ["a", "b", "c<p>"]
    assert text("") == [] and text("<") == ["<"] and text("plain") == ["plain"] and text("<style>p{}") == []
    assert text("<td title='a>b'>x</td></div></p>") == ["x"]


@pytest.fixture(scope="module")
def model():
    return html_crf.train()


def test_field_reads_unseen_layouts(model):
    right = total = 0
    for page, labels in html_crf.labelled_pages(120, seed=99):
        blocks = [(b, t) for b in html_crf.leaf_blocks(page) if (t := b.text())]
        got = model.decode([model.scores(b, len(t)) for b, t in blocks])
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total > 0.97


def test_viterbi_against_all_labellings(model):
    import itertools

    rng = random.Random(8)
    for n in range(1, 8):
        s = [(rng.uniform(-2, 2), rng.uniform(-2, 2)) for _ in range(n)]
        value = lambda y: model.first[y[0]] + sum(s[k][y[k]] for k in range(n)) + sum(model.steps[y[k - 1], y[k]] for k in range(1, n))  # noqa: B023, E731
        assert tuple(model.decode(s)) == max(itertools.product((0, 1), repeat=n), key=value)


def test_extraction_of_a_table(spark, model):
    page = "<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Title &amp; more</h1><p>First  sentence here,\n and more of it.</p><p>Second one.</p></article><div class=comments><p>I disagree with this.</p></div><footer>&copy; x</footer></body></html>"
    got = {(r["page_id"], r["url"]): r for r in html_crf.extract_text(pages(spark, [(1, "u", page), (2, "u", None), (3, "u", ""), (None, None, page), (1, "u", page), (4, "u", "<p>" * 5000 + "x")]), model).collect()}
    assert got[1, "u"]["text"] == "Title & more\nFirst sentence here, and more of it.\nSecond one." and got[1, "u"]["n_chars"] == len(got[1, "u"]["text"])
    assert got[2, "u"]["text"] == got[3, "u"]["text"] == "" and got[None, None]["text"] == got[1, "u"]["text"]
    assert html_crf.extract_text(pages(spark, []), model).count() == 0

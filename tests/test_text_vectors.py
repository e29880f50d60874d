import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.operators import chunks, html, limits, vectors
from tamarack.sources import files, search_api
from tamarack.streaming import ingest

PAGE = """<html><head><title> A &amp; B </title><style>x{}</style></head><body><!-- no --><nav><p>menu</p></nav><header>top</header>
<p>One <b>two<p>three</p><script>if (a < b) { document.write("</p>") }</script>
<table><tr><th>Gear</th><th colspan=2>Force</th></tr><tr><td>1</td><td> 5 </td></tr><tr></tr></table><table><tr><td>x</td></tr></table>
<a href="/d/a.PDF">s</a><a href="b.pdf?x=1">t</a><img src="i.png"><footer>foot</footer>last"""


def test_html():
    title, text, tables, pdfs, images, n = html.parse_html(PAGE, "https://h.example/p/")
    assert title == "A & B" and n == len(text)
    assert text.split("\n") == ["A & B", "One", "two", "three", "Gear", "Force", "1", "5", "x", "s", "t", "last"]
    assert tables == [[["Gear", "Force", ""], ["1", "5"]]]
    assert pdfs == ["https://h.example/d/a.PDF"] and images == ["https://h.example/p/i.png"]
    assert "top" in html.parse_html(PAGE, "", ("script",))[1]


def test_html_frame(spark):
    df = spark.createDataFrame([(1, "https://h.example/", PAGE + "x" * 200), (2, "u", None), (3, "u", ""), (4, "u", "<p>short</p>")], "id int, url string, html string")
    got = html.pages(df).collect()
    assert [r.id for r in got] == [1] and got[0].pdf_links == ["https://h.example/d/a.PDF"]


@pytest.mark.parametrize(("n", "size", "overlap"), [(0, 5, 2), (1, 5, 2), (5, 5, 0), (6, 5, 4), (23, 7, 3)])
def test_chunks(spark, n, size, overlap):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(1, "  ".join(words), "u")], "id int, text string, url string")
    got = [r.chunk.split() for r in chunks.chunk_words(df, size, overlap, name=["id"]).orderBy("chunk_no").collect()]
    assert got == [words[s : s + size] for s in range(0, n, size - overlap)]


def test_chunk_bounds(spark):
    df = spark.createDataFrame([(None, "u"), ("  ", "u")], "text string, url string")
    assert chunks.chunk_words(df).count() == 0
    for bad in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            chunks.chunk_words(df, *bad)


def test_search(spark):
    rows = [("a", "x", [1.0, 0.0], "t"), ("b", "x", [0.6, 0.8], "t"), ("c", "y", [1.0, 0.0], "t"), ("d", "y", None, "t"), ("e", "y", [0.0, 0.0], "t"), ("f", "y", [1.0], "t"), ("g", "y", [float("nan"), 1.0], "t")]
    df = spark.createDataFrame(rows, "chunk_id string, brand string, embedding array<float>, text string")
    found = vectors.search(df, [1.0, 0.0], 3)
    assert [(r.chunk_id, round(r.distance, 5)) for r in found.collect()] == [("a", 0.0), ("c", 0.0), ("b", 0.4)]
    assert [r.chunk_id for r in vectors.search(df, [1.0, 0.0], 3, "x").collect()] == ["a", "b"]
    assert vectors.shown(found).first()["score"] == 1.0
    texts = vectors.hashing_encoder(64)(spark.createDataFrame([("p", "haul truck tyre"), ("q", "hydraulic shovel"), ("r", None)], "chunk_id string, text string"))
    assert vectors.search_text(texts, "haul truck", vectors.hashing_encoder(64), 1).first()["chunk_id"] == "p"


def test_knn_against_brute_force(spark):
    x = np.random.default_rng(1).standard_normal((150, 8)).astype("float32")
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id bigint, embedding array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    got = {(r["query"], r.near) for r in vectors.knn(df.where("vec_id % 10 = 0"), df, 4, dims=8, block=32).collect()}
    assert got == {(i, int(j)) for i in range(0, 150, 10) for j in np.argsort(-s[i])[:4]}


def test_limits(spark):
    df = spark.createDataFrame([(1, "a", t) for t in (0, 30, 59, 60, 61)], "id int, k string, t int").withColumn("ts", F.timestamp_seconds("t"))
    assert [r.in_window for r in limits.calls_in_window(df, "k").orderBy("t").collect()] == [1, 2, 3, 3, 4]
    robots = spark.createDataFrame([("h.example", "/", True, "2024-01-01 00:00:00"), ("h.example", "/private", False, "2024-01-01 00:00:00"), ("old.example", "/", False, "2023-12-31 00:00:00")], "host string, path_prefix string, allow boolean, f string").withColumn("fetched_at", F.to_timestamp("f"))
    u = spark.createDataFrame([("https://h.example/a",), ("https://h.example/private/x",), ("https://old.example/x",), ("https://new.example/",)], "url string")
    assert {r.url for r in limits.allowed(u, robots, "2024-01-01 00:30:00").collect()} == {"https://h.example/a", "https://old.example/x", "https://new.example/"}


def fake(engine, query, options):
    return {"items": [{"title": query, "link": "https://h.example/1"}], "organic": [{"title": "o", "link": "https://h.example/2", "snippet": "s"}]}


def test_search_source(spark, tmp_path):
    spark.dataSource.register(search_api.SearchSource)
    r = spark.read.format("search_api").option("queries", json.dumps(["q1", "q2"])).option("engine", "serper").load()
    assert r.count() == 0  # no key
    assert search_api.results("google", fake("google", "q", {})) == [{"title": "q", "url": "https://h.example/1", "snippet": ""}]
    (tmp_path / "r.json").write_text(json.dumps(fake("g", "q", {})))
    got = {(x.source_engine, x.url) for x in files.search_responses(spark, str(tmp_path)).collect()}
    assert got == {("google", "https://h.example/1"), ("serper", "https://h.example/2")}


def test_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>x</p>")
    (tmp_path / "b.pdf").write_bytes(b"%PDF one")
    (tmp_path / "c.pdf").write_bytes(b"broken")

    def parse(content):
        if content == b"broken":
            raise ValueError
        return ["p1", "p2"], [[["a", None], ["b", "c"]]]

    assert files.raw_pages(spark, str(tmp_path)).first()["html"] == "<p>x</p>"
    d = files.pdf_documents(spark, str(tmp_path), parse).collect()
    assert [(r.title, r.text_content, r.tables) for r in d] == [("PDF: b.pdf", "p1\n\np2", [[["a", ""], ["b", "c"]]])]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, "https://a.example/1", "Operating weight: 50 ton", "2024-01-01 00:00:00"), (2, "https://a.example/1", "Operating weight: 50 ton", "2024-01-01 01:00:00"), (3, "https://a.example/2", "Max torque: 900 Nm", "2024-01-01 02:00:00")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, text_content string, t string").select("page_id", "url", "text_content", F.array().cast("array<array<array<string>>>").alias("tables"), F.to_timestamp("t").alias("scraped_at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = ingest.facts(ingest.new_pages(ingest.page_stream(spark, str(tmp_path / "in"), df.schema)))
    q = s.writeStream.format("memory").queryName("facts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.url, r.parameter, r.value) for r in spark.table("facts").collect()}
    assert got == {(r.url, r.parameter, r.value) for r in ingest.facts(df.dropDuplicates(["url"])).collect()} and len(got) >= 2

import os

import pytest
from pyspark.sql import functions as F

from tamarack import cli, pipeline
from tamarack.operators.warehouse import Warehouse

BRANDS = "tier_1: {b: {nombre_completo: B Works, sitio_web: 'https://b.example', equipos: {carguio: [{tipo: Pala, series: [M1]}]}}, c: {equipos: {transporte: [{tipo: Camion, series: [T1]}]}}}"
TEXT = "<html><head><title>t</title></head><body><p>Operating weight: {w} ton. Engine power: 780 hp.</p><p>Rimpull: 1st: 900 kN, 2nd: 500 kN.</p><p>" + "words " * 40 + "</p></body></html>"


@pytest.fixture
def offline(spark, tmp_path):
    rows = [("B Works M1 brochure mining equipment", i, f"r{i}", u, "s", "google") for i, u in enumerate(["https://b.example/1", "https://b.example/2", "https://www.youtube.com/x", "http://[::1]/x"])]
    rows += [("c T1 brochure mining equipment", 0, "r", "https://c.example/1", "s", "serper"), ("no machine's query", 0, "r", "https://d.example/1", "s", "serper")]
    spark.createDataFrame(rows, "query string, seq int, title string, url string, snippet string, source_engine string").write.parquet(f"{tmp_path}/off/results.parquet")
    pages = [(f"https://{h}.example/{i}", TEXT.format(w=w)) for h, i, w in (("b", 1, 200), ("b", 2, 202), ("c", 1, 300), ("d", 1, 900))]
    spark.createDataFrame(pages, "url string, html string").write.parquet(f"{tmp_path}/off/pages.parquet")
    os.makedirs(tmp_path / "config")
    (tmp_path / "config" / "brands.yaml").write_text(BRANDS)
    return tmp_path


def test_run_resume_and_fresh(spark, offline, capsys):
    t = offline
    run = lambda *more: cli.main(["run", f"{t}/w", "--config", f"{t}/config", "--offline", f"{t}/off", "--out", f"{t}/out", *more])
    said = lambda: dict(x.rsplit(" ", 1) for x in capsys.readouterr().out.strip().splitlines()[-1].split(", "))
    assert run() == 0
    first = said()
    assert (first["results"], first["accepted"], first["pages"]) == ("5", "3", "3")
    store = Warehouse(spark, f"{t}/w")
    specs = {(r.parameter, r.value) for r in store.read("technical_specs").collect()}
    assert ("potencia_motor", "780") in specs and ("peso_operativo", "300") in specs
    assert store.read("rimpull_points").count() == 4 and store.read("data_sources").count() == 3 and store.read("search_log").count() == 2
    assert spark.read.parquet(f"{t}/w/vectors").count() >= 3
    n = store.read("technical_specs").count()
    assert run() == 0 and said()["accepted"] == "0"  # all visited
    assert store.read("technical_specs").count() == n
    assert run("--fresh", "--brand", "b") == 0 and said()["accepted"] == "2"
    assert store.read("technical_specs").count() == n
    assert run("--brand", "nobody") == 2
    page = open(f"{t}/out/report.html", encoding="utf-8").read()
    assert "B Works" in page and "polyline" in page and os.path.isdir(f"{t}/out/data") and os.path.isdir(f"{t}/out/csv/pivot")
    assert cli.main(["query", f"{t}/w", "operating weight", "--store", "--brand", "b"]) == 0 and "B Works" in capsys.readouterr().out
    assert cli.main(["backup", f"{t}/w", "--out", f"{t}/copy"]) == 0 and spark.read.parquet(f"{t}/copy/brands").count() == 2
    assert cli.main(["clean", f"{t}/w", "--brand", "c"]) == 0 and cli.main(["clean", f"{t}/w"]) == 2
    assert store.read("technical_specs").count() < n and cli.main(["status", f"{t}/w", "--store"]) == 0


def test_upsert_writes_the_buckets_that_a_batch_falls_into(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    w.create()
    rows = lambda n, v: spark.createDataFrame([(i, f"k{i}", v) for i in n], "id bigint, key string, name string")
    w.append("brands", rows([900], "old"))
    assert w.upsert("brands", rows(range(300), "a"), ["key"]) == w.BUCKETS
    before = w.manifest("brands")["buckets"]
    assert w.upsert("brands", rows([5], "b"), ["key"]) == 1
    after = w.manifest("brands")["buckets"]
    assert sum(before[k] != after[k] for k in before) == 1
    got = {r.key: r.name for r in w.read("brands").collect()}
    assert len(got) == 301 and got["k5"] == "b" and got["k6"] == "a" and got["k900"] == "old"
    reader = w.read("brands")  # planned on the old manifest
    w.upsert("brands", rows([6], "c"), ["key"])
    assert reader.where("key = 'k6'").first().name == "a" and w.vacuum("brands") >= 1
    assert w.read("brands").where("key = 'k6'").first().name == "c"
    w.append("brands", rows([901], "d"))
    assert w.read("brands").count() == 302


def test_the_report_holds_every_row(spark, tmp_path):
    from tamarack.operators import report

    specs = spark.range(60_000).select(F.concat(F.lit("Br "), F.col("id") % 3).alias("brand"), F.lit("</script>").alias("model"), F.lit("t").alias("equipment_type"), F.lit("p").alias("parameter"), F.col("id").cast("string").alias("value"), F.lit("u").alias("unit"), F.lit(0.8).alias("confidence"))
    page = report.html_report(specs, str(tmp_path / "r" / "report.html"))
    lines = [x for f in (tmp_path / "r" / "data").rglob("*.js") for x in f.read_text().splitlines()]
    assert len(lines) == 60_000 and all(x.startswith("row({") and "</script>" not in x for x in lines)
    assert "</script>" not in open(page).read().split("const report=")[1].split(";</script>")[0]

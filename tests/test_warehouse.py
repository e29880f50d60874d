from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tamarack import config
from tamarack.operators import report, search, warehouse


def frames(spark):
    e = spark.createDataFrame([(1, 1, "A", "m1", "carguio", "Pala"), (2, 1, "A", "m2", "transporte", "Camion"), (3, 2, "B", "m3", None, None)], "id bigint, brand_id bigint, brand string, model string, category string, equipment_type string")
    t = datetime(2024, 1, 1)
    s = spark.createDataFrame([(1, 1, "torque", "5", "Nm", 0.9, "u", t), (2, 1, "peso_operativo", None, "ton", 0.4, "u", t), (3, 2, "torque", "7", "Nm", 0.6, "v", t)], "id bigint, equipment_id bigint, parameter string, value string, unit string, confidence double, source_url string, extracted_at timestamp")
    u = spark.createDataFrame([(1, "u"), (1, "u"), (2, "v"), (9, "w")], "equipment_id bigint, url string")
    return e, s, u


def test_status_counts_zero(spark):
    e, s, u = frames(spark)
    b = warehouse.brand_table(e)
    got = {r.brand: (r.models, r.specs, r.sources) for r in warehouse.brand_status(b, e, s, u).collect()}
    assert got == {"A": (2, 3, 3), "B": (1, 0, 0)}
    assert [(r.model, r.specs) for r in warehouse.model_counts(e, s).collect()] == [("m1", 2), ("m2", 1), ("m3", 0)]
    assert {r.url for r in warehouse.visited_urls(b, e, u, "A").collect()} == {"u", "v"}


def test_store(spark, tmp_path):
    w = warehouse.Warehouse(spark, f"file://{tmp_path}/w")
    w.create()
    new = spark.createDataFrame([("k", "Name"), ("k", "Name"), ("l", "Other")], "key string, name string")
    for _ in range(2):  # idempotent
        w.insert_absent("brands", new, ["key"])
    assert w.read("brands").count() == 2 and w.read("brands").select("id").distinct().count() == 2
    e, s, u = frames(spark)
    w.replace("equipment", w.read("equipment").unionByName(e.drop("brand"), allowMissingColumns=True))
    w.append("technical_specs", s)
    counts = {r.table_name: r.removed for r in w.clear_brand(1).collect()}
    assert counts == {"technical_specs": 3, "data_sources": 0, "rimpull_points": 0, "equipment": 2}
    assert w.read("technical_specs").count() == 0 and w.read("equipment").count() == 1
    assert {r.table_name: r.removed for r in w.clear_brand(77).collect()} == {"technical_specs": 0, "data_sources": 0, "rimpull_points": 0, "equipment": 0}
    w.backup(f"file://{tmp_path}/copy")
    assert spark.read.parquet(f"{tmp_path}/copy/brands").count() == 2


def test_failed_write_leaves_the_table(spark, tmp_path):
    w = warehouse.Warehouse(spark, f"file://{tmp_path}/w")
    w.create()
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        w.replace("brands", bad)
    assert w.read("brands").count() == 0


def test_report(spark, tmp_path):
    e, s, _ = frames(spark)
    f = s.join(e.withColumnRenamed("id", "equipment_id"), "equipment_id")
    p = {r.model: (r.torque, r.peso_operativo) for r in report.pivot(f, ["torque", "peso_operativo"]).collect()}
    assert p == {"m1": ("5", None), "m2": ("7", None)}
    assert report.heatmap(f).count() == 4
    assert report.filtered(f, brand="A", least=0.5, model="M1").count() == 1
    page = report.html_report(f.withColumn("value", F.lit("</script><!--")), str(tmp_path / "r" / "report.html"))
    text = open(page, encoding="utf-8").read()
    assert "m1" in text and "</script><!--" not in text
    assert report.html_report(f.where("false"), str(tmp_path / "x.html")) == ""
    report.write_csv(f, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "by_brand" / "brand_file=A")).count() == 3
    assert '"models": 2' in report.summary_json(f)


def test_search(spark):
    c = {"tier_2": {"b": {"equipos": {"carguio": [{"tipo": "Pala", "series": ["X1", "X2"]}]}}}, "tier_1": {"a": {"nombre_completo": "Alpha", "equipos": {"transporte": [{"tipo": "Camion", "series": ["T1"]}]}}}}
    b = search.brands(spark, c)
    assert [(r.key, r.name) for r in b.orderBy("seq").collect()] == [("a", "Alpha"), ("b", "b")]
    m = search.models(b)
    assert [r.model for r in m.orderBy("seq", "g", "m").collect()] == ["T1", "X1", "X2"]
    q = search.queries(m.withColumnRenamed("name", "brand"))
    assert q.count() == 60 and q.where(F.contains("query", F.lit("{"))).count() == 0
    r = spark.createDataFrame([(1, "https://a.example/1"), (2, "https://a.example/1"), (3, "https://youtube.com/x"), (4, "https://b.example/"), (5, None), (6, "http://10.0.0.1/")], "seq int, url string")
    seen = spark.createDataFrame([("https://b.example/",), (None,)], "url string")
    assert [x.seq for x in search.accept(r, seen).collect()] == [1]


def test_settings(tmp_path):
    assert config.settings({})["nlp.chunk_size"] == 512
    for bad in ({"scraping": {"timeout_seconds": 301}}, {"nlp": {"chunk_overlap": 512}}, {"nlp": {"chunk_size": "many"}}, {"storage": {"reports_dir": "/etc/x"}}, {"storage": {"reports_dir": "../x"}}, {"scraping": {"max_retries": True}}):
        with pytest.raises(ValueError):
            config.settings(bad)
    with pytest.raises(ValueError):
        config.check_brands({"tier_1": {"x": {"sitio_web": "ftp://x"}}})
    assert config.check_brands({"tier_1": {"x": {"sitio_web": "https://x.example"}, "y": None}, "tier_2": None})
    (tmp_path / "s.yaml").write_text("scraping: {max_retries: 1}\n")
    assert config.load_settings(str(tmp_path), "s.yaml")["scraping.max_retries"] == 1
    with pytest.raises(ValueError):
        config.load_yaml(str(tmp_path), "../s.yaml")

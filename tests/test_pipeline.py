import os

import pytest
from pyspark.sql import functions as F

from tamarack import cli, pipeline
from tamarack.operators import vectors

DIR = "/root/testdata/sf0.001"


def pages(spark):
    text = "Operating weight: {w} ton. Engine power: 780 hp. Rimpull: 1st: {f} kN, 2nd: 500 kN. " + "x" * 100
    rows = [(f"https://a.example/{i}", text.format(w=w, f=f), [[["Parameter", "Value"], ["Max torque", f"{t} Nm"], ["Dump height", "n/a"]]]) for i, w, f, t in ((1, 200, 900, 5000), (2, 202, 905, 5050), (3, 400, 300, 9000))]
    fetched = spark.createDataFrame([*rows, ("https://a.example/4", "short", [])], "url string, text_content string, tables array<array<array<string>>>")
    results = spark.createDataFrame([(1, "https://a.example/1", "B", "M"), (2, "https://a.example/1", "X", "Y"), (3, "https://a.example/2", "B", "M"), (4, "https://a.example/3", "B", "M"), (5, "https://a.example/4", "B", "M")], "seq int, url string, brand string, model string")
    return pipeline.scraped(results, fetched)


def test_lineage(spark):
    p = pages(spark)
    assert {(r.url[-1], r.brand) for r in p.collect()} == {("1", "B"), ("2", "B"), ("3", "B")}
    out = pipeline.extracted(p)
    facts = {(r.url[-1], r.parameter): r.value for r in out["facts"].collect()}
    assert facts["1", "peso_operativo"] == "200" and facts["3", "torque"] == "9000" and facts["2", "altura_descarga"] == "n/a"
    agreed = {r.parameter: r for r in out["consensus"].collect()}
    assert agreed["peso_operativo"].source_count == 3 and agreed["peso_operativo"].best_value in ("200", "202") and not agreed["peso_operativo"].consensus
    assert agreed["torque"].best_value in ("5000", "5050") and "altura_descarga" not in agreed
    curve = {r.gear: r.force_kn for r in out["curves"].collect()}
    assert curve == {"1st": 900.0, "2nd": 500.0} or curve == {"1st": 905.0, "2nd": 500.0}
    report = out["report"].first()
    assert report.total_input == 4 and report.total_rejected == 1 and report.completeness == 1.0


def test_chunks_with_vectors_are_stored_by_brand(spark, tmp_path):
    e = pipeline.embedded(pages(spark), size=10, overlap=2).withColumn("equipment_type", F.lit("t"))
    vectors.store(e, str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert os.listdir(tmp_path / "c/brand=B") and stored.count() == e.count() > 3
    assert stored.where(F.size("embedding") != 256).count() == 0


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["status", DIR, "--brand", "Kalvek Mining Equipment"]) == 0
    assert "Kalvek Mining Equipment" in capsys.readouterr().out
    assert cli.main(["status", DIR, "--brand", "nobody"]) == 2
    assert cli.main(["inventory", DIR]) == 0
    assert cli.main(["queries", DIR, "-n", "3"]) == 0
    assert cli.main(["query", DIR, "wheel motor hours", "-n", "2"]) == 0
    assert cli.main(["report", DIR, "--out", str(tmp_path)]) == 0
    assert os.path.exists(tmp_path / "report.html") and os.path.exists(tmp_path / "summary.json")


def test_persisting_is_idempotent_and_only_for_known_brands(spark, tmp_path):
    from tamarack.operators.warehouse import Warehouse

    store = Warehouse(spark, f"file://{tmp_path}/w")
    store.create()
    store.insert_absent("brands", spark.createDataFrame([("b", "B")], "key string, name string"), ["key"])
    p = pages(spark).withColumn("title", F.lit("t"))
    other = p.withColumn("brand", F.lit("unknown"))
    out = pipeline.extracted(p.unionByName(other).drop("title"))
    for _ in range(2):
        counts = {r.table_name: r.rows for r in pipeline.persist(store, out["consensus"], out["curves"], p, "2024-01-01").collect()}
    assert counts["technical_specs"] == store.read("technical_specs").count() == 3
    assert counts["rimpull_points"] == 2 and counts["data_sources"] == 3
    assert store.read("equipment").count() == 1 and store.read("technical_specs").select("id").distinct().count() == 3


def test_env(tmp_path):
    from tamarack import config

    f = tmp_path / ".env"
    f.write_text("# c\nA=1\nB='x=y'\n")
    f.chmod(0o600)
    assert config.load_env(str(f)) == ({"A": "1", "B": "x=y"}, False)
    f.chmod(0o644)
    assert config.load_env(str(f))[1] and config.load_env(str(tmp_path / "none")) == ({}, False)

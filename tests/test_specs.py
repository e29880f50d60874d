import pytest

from tamarack.functions import rules as R
from tamarack.operators import consensus, qa, specs


def facts(spark, text, url="https://h.example/x"):
    df = spark.createDataFrame([(1, url, text)], "page_id int, url string, text string")
    return [(r.parameter, r.value, r.unit) for r in specs.from_text(df).orderBy("seq").collect()]


def test_catalogue():
    assert len(R.patterns()) == 82 and len(R.TEXT_PATTERNS) == 36 and len(R.labels()) == 103
    assert all(len(a) >= len(b) for (a, _), (b, _) in zip(R.labels(), R.labels()[1:]))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Operating weight: 1,250 kg", ("peso_operativo", "1250", "kg")),
        ("Engine power 780 HP", ("potencia_motor", "780", "hp")),
        ("Potencia: 500 cv", ("potencia_motor", "500", "hp")),
        ("Payload capacity: 290 tonnes", ("capacidad_carga", "290", "ton")),
        ("Profundidad de excavación: 8.5 m", ("profundidad_excavacion", "8.5", "m")),
        ("capacidad del tanque 2,000 litros", ("capacidad_tanque", "2000", "L")),
        ("Max rimpull: 950 kN", ("rimpull_maximo", "950", "kN")),
        ("Engine model: Cummins QSK60", ("modelo_motor", "Cummins QSK60", "")),
        ("Tier 4 Final", ("norma_emisiones", "4 Final", "")),
        ("Operating weight: 22 ton", ("peso_operativo", "22", "ton")),
    ],
)
def test_text(spark, text, expected):
    assert expected in facts(spark, text)


def test_text_edges(spark):
    df = spark.createDataFrame([(1, None, None), (2, "u", ""), (3, "u", "nothing here but 12 words"), (4, "u", "x " * 150_000)], "page_id int, url string, text string")
    assert specs.from_text(df).count() == 0
    # the first of alternative units wins, as leftmost alternation has it
    assert ("profundidad_excavacion", "9100", "m") in facts(spark, "max digging depth 9,100 mm")


def test_text_is_read_to_its_end(spark):
    df = spark.createDataFrame([(1, "u", "word " * 60_000 + "Operating weight: 22 ton")], "page_id int, url string, text string")
    weight = tuple(p for p in R.patterns() if p.parameter == "peso_operativo")
    assert "22" in [r.value for r in specs.from_text(df, patterns=weight).collect()]


def test_tables(spark):
    tables = [
        [["Parameter", "Value", "Unit"], ["Operating weight", "250", "ton"], ["Dump height", "7.1 m", ""], ["", "1", "m"], ["Nonsense", "1", "m"]],
        [["Engine power", "780 hp"], ["Gross weight", "12,5", "kg", "extra"], ["Bucket capacity"], ["Max torque", None]],
        [],
    ]
    df = spark.createDataFrame([(1, "https://www.cat.com/a", tables)], "page_id int, url string, tables array<array<array<string>>>")
    got = {(r.parameter, r.value, r.unit, r.confidence) for r in specs.from_tables(df).collect()}
    assert got == {("peso_operativo", "250", "ton", 0.99), ("altura_descarga", "7.1", "m", 0.99), ("potencia_motor", "780", "hp", 0.99), ("peso_operativo", "125", "kg", 0.99), ("torque", "", "", 0.99)}


def test_normalize_and_range(spark):
    df = spark.createDataFrame([("peso_operativo", "500000", "kg", 0.8), ("ancho_total", "9100", "mm", 0.8), ("peso_operativo", "5", "ton", 0.8), ("peso_operativo", "x", "kg", 0.8), ("torque", "200", "Nm", None)], "parameter string, value string, unit string, confidence double")
    got = [tuple(r) for r in specs.check_range(specs.normalize(df)).select("parameter", "value", "unit", "confidence").collect()]
    assert set(got) == {("peso_operativo", "500.0", "ton", 0.8), ("ancho_total", "9.1", "m", 0.8), ("peso_operativo", "5", "ton", 0.3), ("peso_operativo", "x", "kg", 0.8), ("torque", "200", "Nm", None)}


def test_best_keeps_the_first_of_the_most_confident(spark):
    df = spark.createDataFrame([(1, "torque", "200", "Nm", 0.8, 2), (1, "torque", "300", "Nm", 0.8, 1), (1, "torque", "400", "Nm", 0.7, 0)], "p int, parameter string, value string, unit string, confidence double, seq int")
    assert [r.value for r in specs.best_per_parameter(df, ["p"]).collect()] == ["300"]


@pytest.mark.parametrize(
    ("parameter", "value", "unit", "issue"),
    [
        ("peso_operativo", "N/A", "ton", "placeholder"), ("peso_operativo", "---", "ton", "placeholder"), ("peso_operativo", "TBD", "ton", "placeholder"), ("peso_operativo", "0.0", "ton", "placeholder"), ("peso_operativo", "contact dealer", "", "placeholder"),
        ("peso_operativo", "heavy", "ton", "not_numeric"), ("peso_operativo", "0.001", "ton", "out_of_range"), ("peso_operativo", "6", "ton", ""), ("modelo_motor", "QSK60", "", ""), ("peso_operativo", None, "ton", "empty"), ("peso_operativo", " ", "ton", "empty"),
    ],
)
def test_checks(spark, parameter, value, unit, issue):
    df = spark.createDataFrame([(parameter, value, unit)], "parameter string, value string, unit string")
    assert qa.check(df).first()["issue"] == issue


def test_report_and_constraints(spark):
    rows = [(1, 1, "peso_operativo", "100", "ton"), (1, 2, "peso_vacio", "120", "ton"), (1, 3, "torque", "n/a", "Nm"), (2, 4, "potencia_motor", "500", "")]
    df = spark.createDataFrame(rows, "m int, id int, parameter string, value string, unit string")
    r = {x.m: x for x in qa.report(df, ["m"]).collect()}
    assert (r[1].total_valid, r[1].total_rejected, r[1].rejection_rate, r[1].completeness, r[1].missing_core) == (2, 1, 33.3, 0.5, ["potencia_motor"])
    assert r[2].warnings == 1
    assert [tuple(x) for x in qa.constraints(qa.check(df), ["m"], "id").collect()] == [(1, "peso_vacio", "peso_operativo", 120.0, 100.0)]


def test_consensus(spark):
    def run(rows):
        df = spark.createDataFrame([("b", "m", p, v, "ton", c, s, i) for i, (p, v, c, s) in enumerate(rows)], "brand string, model string, parameter string, value string, unit string, confidence double, source_url string, seq int")
        return {x.parameter: x for x in consensus.consensus(df).collect()}

    agree = run([("peso_operativo", "700", 0.8, "a"), ("peso_operativo", "702", 0.82, "b")])["peso_operativo"]
    assert agree.consensus and agree.final_confidence == 0.92 and agree.best_value == "702" and agree.sources == ["a", "b"]
    conflict = run([("peso_operativo", "700", 0.9, "a"), ("peso_operativo", "500", 0.8, "b")])["peso_operativo"]
    assert not conflict.consensus and conflict.best_value == "500" and conflict.final_confidence == 0.85 and "Outliers: 700.0" in conflict.conflict_detail
    major = run([("torque", "1,000", 0.7, "a"), ("torque", "1010", 0.75, "b"), ("torque", "2000", 0.95, "c")])["torque"]
    assert major.best_value == "1010" and not major.consensus
    assert run([("x", "one", None, "a")])["x"].final_confidence == 0.0
    words = run([("x", "A", 0.5, "a"), ("x", "a", 0.6, "b"), ("x", None, 0.1, "c")])["x"]
    assert words.best_value == "a" and words.source_count == 3
    empty = spark.createDataFrame([], "brand string, model string, parameter string, value string, unit string, confidence double, source_url string")
    assert consensus.consensus(empty).count() == 0


def test_consensus_of_a_hot_group(spark):
    from pyspark.sql import functions as F

    n = 100_000
    df = spark.range(n).select(F.lit("b").alias("brand"), F.lit("m").alias("model"), F.lit("torque").alias("parameter"), F.when(F.col("id") % 10 == 0, F.lit("900")).otherwise((F.lit(5000.0) + F.col("id") % 700 / 10).cast("string")).alias("value"), F.lit("Nm").alias("unit"), F.lit(0.5).alias("confidence"), F.concat(F.lit("u"), F.col("id")).alias("source_url"), F.col("id").alias("seq"))
    r = consensus.consensus(df, lists=False).collect()
    assert len(r) == 1 and r[0].source_count == n and not r[0].consensus and r[0].final_confidence == 0.59
    whole = consensus.consensus(df).first()
    assert len(whole.sources) == n * 9 // 10 and whole.conflict_detail.startswith("Conflict: 90000/100000 sources agree on ~5")


def by_hand(values, percent):
    groups = []
    for v in sorted(values):
        mean = sum(groups[-1]) / len(groups[-1]) if groups else None
        if groups and (abs(v - mean) / mean * 100 if mean > 0 else 100.0) <= percent:
            groups[-1].append(v)
        else:
            groups.append([v])
    return groups


@pytest.mark.parametrize("gathered", [100_000, 2])
def test_clusters_against_the_walk_one_by_one(spark, monkeypatch, gathered):
    import random

    from pyspark.sql import functions as F

    monkeypatch.setattr(consensus, "GATHERED", gathered)  # 2: nearly all groups in rows
    rng = random.Random(4)
    groups = {0: [5.0, 5.2, 5.0, 9.0], 1: [0.0, 0.0, -1.0, 3.0, 3.1], 2: [1.0] * 5, 3: [-2.0, -2.0], None: [7.0, 8.0]}
    groups |= {i: [round(rng.lognormvariate(3, 0.4), 1) for _ in range(rng.randint(1, 40))] for i in range(10, 40)}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v double").groupBy("k", "v").agg(F.count("*").alias("n")).withColumn("percent", F.lit(10.0)).withColumn("best", F.struct("v"))
    got = {r.k: r for r in consensus.main_cluster(consensus.clustered(df, ["k"]), ["k"]).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        hand = by_hand(vs, 10.0)
        main = max(hand, key=lambda c: (len(c), -c[0]))
        r = got[k]
        assert (r.agree, r.lo, r.hi, r.numbers, r.clusters) == (len(main), main[0], main[-1], len(vs), len(hand)), k


def test_decimals_are_rounded_by_their_binary_values(spark):
    from pyspark.sql import functions as F

    xs = [i / 100 for i in range(0, 40000, 5)] + [16.15, 10.05, 17.25, 0.35, -16.15, 1e15, 1729.0, 123456.25]
    got = spark.createDataFrame([(xs,)], "x array<double>").select(consensus._decimals(F.col("x")).alias("t")).first().t.split(", ")
    assert [a.lstrip("-") for a in got] == [f"{abs(x):.1f}" for x in xs]

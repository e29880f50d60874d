import pytest
from pyspark.sql import functions as F

from tamarack.operators import curves


@pytest.mark.parametrize(("raw", "name"), [("1st gear", "1st"), (" Low ", "1st"), ("2nd.", "2nd"), ("Gear 3", "3rd"), ("FOURTH gear", "4th"), ("d", "Direct"), ("REV", "Reverse"), ("9th ", "9th")])
def test_gears(spark, raw, name):
    assert spark.createDataFrame([(raw,)], "g string").select(curves.normalize_gear(F.col("g"))).first()[0] == name


def test_force(spark):
    df = spark.createDataFrame([(224809.0, "lbf"), (101972.0, "kgf"), (5.0, "kN"), (5.0, "?")], "v double, u string")
    assert [round(r[0], 6) for r in df.select(curves.to_kn(F.col("v"), F.col("u"))).collect()] == [1000.0, 1000.0, 5.0, 5.0]
    heads = ["Rimpull (lbf) kN", "kgf", "Force", "pull kN"]
    got = spark.createDataFrame([(h,) for h in heads], "h string").select(curves.force_unit(F.col("h"))).collect()
    assert [r[0] for r in got] == ["lbf", "kgf", "kN", "kN"]


def points(spark, table):
    df = spark.createDataFrame([(1, "u", [table])], "p int, url string, tables array<array<array<string>>>")
    return [(r.gear, r.speed_kmh, r.force_kn, r.original_unit) for r in curves.from_tables(df).orderBy("seq").collect()]


def test_tables(spark):
    assert points(spark, [["Gear", "Speed (km/h)", "Rimpull (lbf)"], ["2nd", "10", "112,404.5"], ["1st", "5", "224809"], ["x", "1", "none"]]) == [("1st", 5.0, 1000.0, "lbf"), ("2nd", 10.0, 500.0, "lbf")]
    assert points(spark, [["Gear", "Force kN"], ["1", "900"], ["2", "700"]]) == [("1st", None, 900.0, "kN"), ("2nd", None, 700.0, "kN")]
    assert points(spark, [["a", "b"], ["1st", "900"], ["2nd", "700"]]) == [("1st", None, 900.0, "kN"), ("2nd", None, 700.0, "kN")]
    assert points(spark, [["Gear", "Force"], ["1", "900"]]) == []
    assert points(spark, [["Weight", "x"], ["a", "1"]]) == []


def test_text(spark):
    def run(text):
        df = spark.createDataFrame([(1, "u", text)], "p int, url string, text string")
        return [(r.gear, r.force_kn) for r in curves.from_text(df).orderBy("seq").collect()]

    assert run("1st gear rimpull: 950 kN. Rimpull (2nd gear): 700 kN") == [("1st", 950.0), ("2nd", 700.0)]
    assert run("Rimpull: 1st: 950 kN, 2nd: 750 kN, 3rd: 550 kN") == [("1st", 950.0), ("2nd", 750.0), ("3rd", 550.0)]
    assert run("1st gear rimpull: 950 kN") == [] and run("") == [] and run("rimpull of note") == []


def test_text_is_read_to_its_end(spark):
    df = spark.createDataFrame([(1, "u", "word " * 60_000 + "Rimpull: 1st: 950 kN, 2nd: 750 kN")], "p int, url string, text string")
    assert [(r.gear, r.force_kn) for r in curves.from_text(df).orderBy("seq").collect()] == [("1st", 950.0), ("2nd", 750.0)]


def test_check(spark):
    rows = [("a", "1st", 5.0, 900.0, 1), ("a", "2nd", 9.0, 950.0, 2), ("a", "3rd", 90.0, 500.0, 3), ("a", "4th", None, 0.0, 4), ("a", "5th", None, 20.0, 5), ("a", "Reverse", None, 999.0, 6), ("b", "1st", 5.0, 900.0, 7)]
    ok, report = curves.check(spark.createDataFrame(rows, "c string, gear string, speed_kmh double, force_kn double, seq int"), ["c"])
    r = {x.c: x for x in report.collect()}
    assert (r["a"].total_valid, r["a"].rises, r["a"].passed, r["a"].bad_zero, r["a"].bad_force, r["a"].bad_speed) == (3, 1, True, 1, 1, 1)
    assert not r["b"].passed and {x.c for x in ok.collect()} == {"a"}


def test_consensus(spark):
    rows = [("m", "1st", 5.0, 900.0, 0.8, "a"), ("m", "first", 5.4, 905.0, 0.9, "b"), ("m", "1", None, 400.0, 0.95, "c"), ("m", "2nd", None, 600.0, 0.7, "a"), ("n", "1st", None, 900.0, 0.8, "a"), ("n", "1st", None, 901.0, 0.8, "a")]
    df = spark.createDataFrame([(*r[:4], "kN", *r[4:], r[5]) for r in rows], "m string, gear string, speed_kmh double, force_kn double, original_unit string, confidence double, source_url string, curve string")
    got = {(x.m, x.gear, x.speed_kmh, x.force_kn, x.confidence) for x in curves.consensus(df, ["m"], "curve").collect()}
    assert got == {("m", "1st", 5.2, 905.0, 0.85), ("m", "2nd", None, 600.0, 0.7), ("n", "1st", None, 900.0, 0.8), ("n", "1st", None, 901.0, 0.8)}

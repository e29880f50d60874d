from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tamarack.llm import survivors as S

CATALOG = [("largo_total", "m", 3.0, 25.0), ("peso_operativo", "ton", 10.0, 1500.0), ("norma_emisiones", None, None, None)]
SCHEMA = "candidate_id bigint, run_id bigint, equipment_id bigint, parameter string, value string, unit string, confidence double, source_url string, extracted_at timestamp, part string, top int, layers string"


def t(day):
    return datetime(2024, 1, day)


@pytest.fixture(scope="module")
def run(spark):
    catalog = spark.createDataFrame(CATALOG, "parameter string, common_unit string, low double, high double")

    def go(rows):
        return {(r.run_id, r.equipment_id, r.parameter): r for r in S.survivors(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA), catalog).collect()}

    return go


def one(i, value, unit="m", conf=0.8, url="u", at=None, group=(1, 1, "largo_total")):
    return (i, *group, value, unit, conf, url, at or t(1))


def test_largest_set_across_units(run):
    got = run([one(1, "10.0"), one(2, "1005", "cm", 0.9), one(3, "10,100", "mm", 0.7), one(4, "20", "m", 0.99), one(5, "20.1", None, 0.99), one(6, "n/a", "m", 1.0), one(7, "0", "m", 1.0)])
    r = got[1, 1, "largo_total"]
    assert (r.candidate_id, r.support) == (2, 3)


def test_order_of_preference(run):
    rows = [one(1, "10", conf=0.99, url=" "), one(2, "10", conf=0.8, at=t(3)), one(3, "10", conf=0.8, at=t(5)), one(4, "10", conf=0.8, at=t(5)), one(5, "10", conf=None)]
    r = run(rows)[1, 1, "largo_total"]
    assert r.candidate_id == 3 and r.confidence == 0.8


def test_fields_are_filled_from_the_layers(run):
    g = (1, 2, "norma_emisiones")
    rows = [one(1, "Stage V", None, None, "u", t(9), g), one(2, " stage v ", "x", 0.4, None, t(2), g), one(3, "STAGE V", "y", 0.7, None, t(3), g), one(4, "Tier 2", "z", 1.0, "u", t(9), g)]
    r = run(rows)[g]
    assert r.candidate_id == 1 and r.confidence == 0.7 and r.unit == "y" and set(r.filled) == {"unit", "confidence"} and r.layers >= 2


def test_single_missing_and_null_groups(run):
    rows = [one(1, "10"), one(2, "n/a", group=(2, 2, "largo_total")), one(3, None, group=(2, 2, "largo_total")), one(4, "5", group=(None, None, None)), one(5, "5", group=(None, None, None)), one(6, "", None, None, None, None, (3, 3, "largo_total")), one(7, "9", None, None, None, None, (3, 3, "largo_total"))]
    got = run(rows)
    assert set(got) == {(None, None, None), (3, 3, "largo_total")} and got[None, None, None].candidate_id == 4 and got[3, 3, "largo_total"].candidate_id == 7


def test_empty_and_long(run):
    assert run([]) == {}
    long = "x" * 200_000
    assert run([one(1, long, group=(1, 1, "norma_emisiones")), one(2, long.upper(), group=(1, 1, "norma_emisiones"))])[1, 1, "norma_emisiones"].support == 2


def test_a_large_group_in_parts(run):
    rows = [one(i, f"{10 + (i % 15) / 100:.2f}", conf=(i * 37 % 100) / 100, at=t(1 + i * 13 % 28)) for i in range(1, 900)] + [one(i, "20", conf=1.0) for i in range(900, 1200)]
    r = run(rows)[1, 1, "largo_total"]
    best = max(rows[:899], key=lambda x: (x[6], x[8], -x[0]))
    assert r.candidate_id == best[0] and r.support == 899


def layers_by_hand(rows):
    out = {}
    left = dict(enumerate(rows))
    n = 0
    while left:
        n += 1
        beats = lambda a, b: all(x >= y for x, y in zip(a, b)) and a != b
        top = [k for k, v in left.items() if not any(beats(w, v) for w in left.values())]
        for k in top:
            out[k] = n
            del left[k]
    return out


def test_layers_against_peeling():
    import random

    rng = random.Random(5)
    rows = sorted({(rng.randint(0, 6) / 10, rng.randint(0, 6), rng.randint(0, 3)) for _ in range(90)}, reverse=True)
    sky = S.Skyline()
    assert {i: sky(recent, complete) for i, (_, recent, complete) in enumerate(rows)} == layers_by_hand(rows)


def test_a_hot_group_is_thinned_out_in_parts_and_comes_out_alike(spark, run, monkeypatch):
    import random

    rng = random.Random(6)
    g = (1, 1, "norma_emisiones")
    rows = [one(i, "Stage V", rng.choice([None, "x", "y"]), rng.choice([None, *range(1, 9)]) and rng.randint(1, 99) / 100, rng.choice([None, f"u{i}"]), t(rng.randint(1, 28)) if rng.random() < 0.8 else None, g) for i in range(1, 800)]
    rows = [(*r[:8], None if r[8] == t(1) and rng.random() < 0.5 else r[8]) for r in rows] + [one(0, "Stage V", None, 0.999, "u", t(28), g)]
    whole = run(rows)[g]
    monkeypatch.setattr(S, "PART", 50)
    assert run(rows)[g] == whole and whole.candidate_id == 0 and "unit" in whole.filled and whole.support == 800


def test_a_hundred_thousand_records_of_one_group(spark):
    catalog = spark.createDataFrame(CATALOG, "parameter string, common_unit string, low double, high double")
    df = spark.range(100_000).select(F.col("id").alias("candidate_id"), F.lit(1).cast("bigint").alias("run_id"), F.lit(1).cast("bigint").alias("equipment_id"), F.lit("largo_total").alias("parameter"), (F.lit(10.0) + F.col("id") % 17 / 100).cast("string").alias("value"), F.lit("m").alias("unit"), (F.xxhash64("id") % 1000 / 2000 + 0.5).alias("confidence"), F.when(F.col("id") % 3 > 0, F.lit("u")).alias("source_url"), F.timestamp_seconds(1_700_000_000 + F.xxhash64("id") % 100_000).alias("extracted_at"))
    r = S.survivors(df, catalog).collect()
    assert len(r) == 1 and r[0].support == 100_000


def test_filling_goes_by_layers_and_not_by_policy_alone(run):
    g = (1, 1, "norma_emisiones")
    rows = [one(1, "Stage V", None, 0.9, "u", t(9), g), one(2, "Stage V", "second", 0.5, "u", t(2), g), one(3, "Stage V", "first", 0.6, None, t(3), g)]
    assert run(rows)[g].unit == "second"  # a source goes before confidence where neither dominates
    rows[1] = (2, *rows[1][1:6], 0.5, None, t(2))
    rows[2] = (3, *rows[2][1:6], 0.6, "u", t(3))
    assert run(rows)[g].unit == "first"


def test_a_thousandfold_value_does_not_come_back(run):
    rows = [one(1, "10.0"), one(2, "10.1"), one(3, "10,050", conf=0.99)]
    assert run(rows)[1, 1, "largo_total"].support == 2

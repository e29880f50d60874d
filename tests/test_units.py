import math
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest

from tamarack.functions import quantity as Q
from tamarack.operators import units

CATALOG = [("ancho_total", "m", 2.0, 15.0), ("peso_operativo", "ton", 10.0, 1500.0), ("rimpull_maximo", "kN", 50.0, 2000.0), ("pendiente_maxima", "%", 10.0, 70.0), ("norma_emisiones", None, None, None)]


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(CATALOG, "parameter string, common_unit string, low double, high double")


def read(value, unit="", dim="length", common="m", low=2.0, high=15.0, bare=False):
    d = Q.DIMENSIONS.index(dim)
    k = list(Q.UNITS[dim]).index(common)
    got = Q.read(pa.array([value], pa.string()), pa.array([unit], pa.string()), pa.array([None], pa.string()), np.array([d]), np.array([k]), np.array([low]), np.array([high]), bare)
    return {n: a[0].as_py() for n, a in got.items()}


@pytest.mark.parametrize(
    ("value", "unit", "home"),
    [
        ("9.1 m", "", 9.1), ("910 cm", "m", 9.1), ("9,100 mm", "", 9.1), ("9.100 mm", "mm", None), ("30 ft 0 in", "", 9.144), ("9'9\"", "", 2.9718), ("19-ft 5-in", "ft-in", 5.91820), ("approx. 8.5", "m", 8.5), ("~8,5", "metros", 8.5),
        ("6.46 - 6.85 m", "", 6.46), ("1.5e+01", "ft", 4.572), ("0.009 thousand m", "", 9.0), ("12 000 mm", "", 12.0), ("5.0 m (16.4 ft)", "", 5.0), ("2 mil milímetros", "", 2.0), ("34.2milímetros", "", 0.0342),
    ],
)
def test_values(value, unit, home):
    got = read(value, unit)["home"]
    assert home is None or math.isclose(got, home, rel_tol=1e-6)


def test_open_readings_follow_the_band():
    assert read("9.100 mm", "mm")["home"] == pytest.approx(9.1)  # 9100 falls in the band, 9.1 doesn't
    assert read("30,840", "%", "slope", "%", 10, 70)["number"] == 30.84
    assert read("1,250", "kg", "mass", "ton", 1, 1500)["number"] == 1250
    assert read("45", "°", "slope", "%", 10, 170)["home"] == pytest.approx(100)


@pytest.mark.parametrize("value", [None, "", " ", "0", "0.00", "n/a", "N.D.", "..", "***", "TBD", "contact dealer", "según configuración", "---", "?"])
def test_missing(value):
    assert read(value)["missing"] and read(value)["number"] is None


def test_not_common(spark, catalog):
    t = datetime(2024, 1, 5)
    rows = [
        (1, 1, "ancho_total", "9.1", "m", t), (2, 1, "ancho_total", "910", "", t), (3, 1, "ancho_total", "9.1", None, t), (4, 1, "ancho_total", "910 cm", "m", None), (5, 1, "ancho_total", "9.1", "metros", t), (6, 1, "ancho_total", "0.0091 thousand m", "", t),
        (7, 1, "ancho_total", "n/a", "ft", t), (8, 1, "norma_emisiones", "Tier 4", "ft", t), (9, 1, "ancho_total", "700", "m", t), (10, None, "ancho_total", "7000", "-", None), (11, 1, None, "5", "ft", t), (12, 1, "unknown", "5", "ft", t), (2, 1, "ancho_total", "910", "", t),
        (13, 1, "ancho_total", "x" * 100_000 + " 900 cm", "", t), (14, 1, "ancho_total", None, None, None),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id bigint, equipment_id bigint, parameter string, value string, unit string, extracted_at timestamp, month string, idx int")
    got = sorted(r.record_id for r in units.not_common(units.spec_records(df), catalog).collect())
    assert got == [2, 2, 4, 6, 10, 13]
    by_id = {r.record_id: r for r in units.normalize_units(units.spec_records(df), catalog).collect()}
    assert by_id[2].unit == "cm" and by_id[2].value_common == pytest.approx(9.1) and by_id[2].decoded
    assert by_id[10].unit == "mm" and by_id[4].value_common == pytest.approx(9.1) and not by_id[4].decoded


def test_every_record_comes_out(spark, catalog):
    t = datetime(2024, 1, 5)
    rows = [(1, 1, "ancho_total", "9.1", "m", t), (2, 1, "ancho_total", "n/a", "m", t), (3, None, "ancho_total", None, None, None), (4, 1, "norma_emisiones", "Tier 4", "", t), (5, 1, None, "5", "ft", t), (6, 1, "unknown", "5", "ft", t), (7, 1, "ancho_total", "910", "", t), (7, 1, "ancho_total", "0", "m", t)]
    specs = spark.createDataFrame(rows, "id bigint, equipment_id bigint, parameter string, value string, unit string, extracted_at timestamp")
    points = spark.createDataFrame([(8, 1, None, "lbf", t), (9, 1, 900.0, "kN", t)], "id bigint, equipment_id bigint, force_kn double, original_unit string, extracted_at timestamp")
    got = units.normalize_units(units.spec_records(specs).unionByName(units.point_records(points)), catalog).collect()
    assert sorted(r.record_id for r in got) == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9]
    none = [r for r in got if r.number is None]
    assert sorted(r.record_id for r in none) == [2, 3, 4, 5, 6, 7, 8]
    assert all(x is None for r in none for x in (r.unit, r.value_common, r.decoded, r.is_common))
    assert {r.record_id: r.common_unit for r in none} == {2: "m", 3: "m", 4: None, 5: None, 6: None, 7: "m", 8: "kN"}


def test_points(spark, catalog):
    rows = [(1, 1, 900.0, "kN"), (2, 1, 5200.0, " KN "), (3, 1, 200000.0, "lbf"), (4, 1, 890.0, "lbf"), (5, 1, 0.5, "MN"), (6, 1, 0.0, "N"), (7, 1, None, "lbf"), (8, None, 95000.0, None), (9, 1, 900000.0, "newtons")]
    df = spark.createDataFrame([(*r, datetime(2024, 1, 1)) for r in rows], "id bigint, equipment_id bigint, force_kn double, original_unit string, extracted_at timestamp")
    found = {r.record_id: r for r in units.normalize_units(units.point_records(df), catalog).where("not is_common").collect()}
    assert sorted(found) == [3, 5, 8, 9]
    assert found[3].unit == "lbf" and found[3].value_common == pytest.approx(889.64, abs=0.01) and found[5].value_common == pytest.approx(500) and found[9].unit == "N"


def test_empty(spark, catalog):
    df = spark.createDataFrame([], "id bigint, equipment_id bigint, parameter string, value string, unit string, extracted_at timestamp")
    assert units.normalize_units(units.spec_records(df), catalog).count() == 0


def viterbi_by_hand(hard, nb, s1, s2, fit, level, logf):
    """One chain, states tried one by one."""
    n, k = hard.shape
    score = back = None
    lev = np.nan
    out = []
    for t in range(n):
        lev = lev if np.isnan(level[t]) else level[t] if np.isnan(lev) else units.SMOOTH * lev + (1 - units.SMOOTH) * level[t]
        base = 0.0 if np.isnan(lev) else lev
        e = np.array([-1e9 if np.isnan(logf[t, j]) else -(s2[t] + 2 * s1[t] * (logf[t, j] - base) + nb[t] * (logf[t, j] - base) ** 2) / (2 * units.SIGMA**2) + units.AGAINST * (nb[t] - fit[t, j]) + units.AGAINST * (hard[t].sum() - hard[t, j]) for j in range(k)])
        if t == 0:
            score, out = e, []
        else:
            cost = score[:, None] + np.where(np.eye(k, dtype=bool), 0, units.SWITCH)
            back = cost.argmax(0)
            out.append(back)
            score = cost.max(0) + e
    path = [int(score.argmax())]
    for b in reversed(out):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_viterbi_against_one_chain_at_a_time():
    rng = np.random.default_rng(3)
    k = Q.STATES
    lengths = [1, 7, 3, 12, 2]
    n = sum(lengths)
    first = np.zeros(n, bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    hard = rng.integers(0, 3, (n, k)).astype(float)
    nb = rng.integers(0, 3, n).astype(float)
    x = rng.normal(3, 2, n)
    s1, s2 = nb * x, nb * x * x
    fit = np.minimum(rng.integers(0, 3, (n, k)), nb[:, None]).astype(float)
    level = np.where(rng.random(n) < 0.3, np.nan, rng.normal(2, 0.5, n))
    logf = np.tile(np.where(np.arange(k) < 6, np.linspace(-4, 4, k), np.nan), (n, 1))
    state, _ = units._viterbi(hard, nb, s1, s2, fit, level, logf, first)
    at = 0
    for m in lengths:
        i = slice(at, at + m)
        assert state[i].tolist() == viterbi_by_hand(hard[i], nb[i], s1[i], s2[i], fit[i], level[i], logf[i])
        at += m


def test_the_model_decodes_planted_switches_of_unit(spark, catalog, monkeypatch):
    rng = np.random.default_rng(8)
    factor, rows, true = {"cm": 100.0, "in": 1 / 0.0254}, [], {}
    for device in range(12):
        for month in range(1, 13):
            unit = "cm" if (month <= 5) == (device % 2 == 0) else "in"  # one switch a device
            for _ in range(10):
                i = len(rows) + 1
                metres = float(np.exp(rng.normal(np.log(5.5), 0.35)))
                rows.append((i, device, "ancho_total", f"{metres * factor[unit]:.1f}", "", datetime(2024, month, 3)))
                true[i] = unit
    for device in range(12):
        for j in range(4):  # a few that state their unit give the level
            rows.append((len(rows) + 1, device, "ancho_total", f"{np.exp(rng.normal(np.log(5.5), 0.2)):.2f}", "m", datetime(2024, 1 + 3 * j, 9)))
    df = spark.createDataFrame(rows, "id bigint, equipment_id bigint, parameter string, value string, unit string, extracted_at timestamp")

    def right():
        got = units.normalize_units(units.spec_records(df), catalog).where("decoded").collect()
        return np.mean([true[r.record_id] == r.unit for r in got])

    with_states = right()
    monkeypatch.setattr(units, "SWITCH", 0.0)  # months tell nothing about each other, nor about a record
    assert with_states > 0.97 and right() < with_states - 0.05


def test_noughts_rounded_in_a_larger_scale(spark, catalog):
    rows = [(1, 1, "ancho_total", "0. million cm", "", None), (2, 1, "ancho_total", "0 m", "", None), (3, 1, "ancho_total", "0", "cm", None)]
    df = spark.createDataFrame(rows, "id bigint, equipment_id bigint, parameter string, value string, unit string, extracted_at timestamp")
    assert [r.record_id for r in units.not_common(units.spec_records(df), catalog).collect()] == [1]

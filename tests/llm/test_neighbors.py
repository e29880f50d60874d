import numpy as np
import pytest

from tamarack.llm import neighbors as N


def frame(spark, rows):
    df = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    return df.withColumn("list", df.chunk_id).withColumn("group", df.chunk_id)


def brute(ids, x, k):
    x = x.astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    out = {}
    for i, a in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(s[i, j], 12), ids[j]))
        out[a] = [ids[j] for j in order[:k]]
    return out


def test_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 16))
    x = (centres[rng.integers(0, 12, 900)] + 0.5 * rng.standard_normal((900, 16))).astype("float32")
    ids = [f"c{i:04d}" for i in range(900)]
    df = frame(spark, [(i, [float(v) for v in r]) for i, r in zip(ids, x)])
    got = {}
    for r in N.nearest(df, 5, 16, 0.98).collect():
        got.setdefault(r.chunk_id, {})[r["rank"]] = r.near
    true = brute(ids, x, 5)
    assert all(len(v) == 5 for v in got.values()) and len(got) == 900
    assert sum(len(set(got[i].values()) & set(true[i])) for i in ids) >= 0.95 * 5 * 900


def test_copies_ties_and_unusable(spark):
    e = lambda *v: [float(x) for x in v]
    rows = [(f"k{i}", e(1, 0, 0)) for i in range(9)] + [("a", e(0, 1, 0)), ("b", e(0, 1, 0.1)), ("z", e(0, 0, 0)), ("n", None), ("s", e(1, 2)), ("q", e(float("nan"), 1, 1)), ("m", []), ("i", e(float("inf"), 1, 1)), (None, e(1, 1, 1)), ("x", [1.0, None, 2.0])]
    got = {}
    for r in sorted(N.nearest(frame(spark, rows), 5, 3).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.chunk_id, []).append(r.near)
    assert set(got) == {*(f"k{i}" for i in range(9)), "a", "b"}
    assert got["k0"] == ["k1", "k2", "k3", "k4", "k5"] and got["k3"] == ["k0", "k1", "k2", "k4", "k5"] and got["a"][:1] == ["b"] and got["a"][1:] == ["k0", "k1", "k2", "k3"]
    p = N.pairs(N.nearest(frame(spark, rows), 5, 3)).collect()
    assert all(r.chunk_id_a < r.chunk_id_b for r in p) and len(p) == len(set(p))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few(spark, n):
    rows = [(f"k{i}", [1.0, float(i)]) for i in range(n)]
    assert N.nearest(frame(spark, rows), 5, 2).count() == n * (n - 1)


def test_many_equal_similarities():
    s = np.zeros((2, 100))
    s[1, 50] = 1
    at, _ = N.top(s, None, 5)
    assert at[0].tolist() == [0, 1, 2, 3, 4] and at[1].tolist() == [50, 0, 1, 2, 3]


def shuffled(spark):
    """Bytes that the session's stages have written to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), spark.sparkContext._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_vectors_are_not_shuffled_once_for_each_block_that_they_meet(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 128)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((4000, 64)).astype("float32")
    ids = [f"c{i:04d}" for i in range(4000)]
    df = frame(spark, [(i, [float(v) for v in r]) for i, r in zip(ids, x)])
    before = shuffled(spark)
    got = {}
    for r in N.nearest(df, 5, 64, 1.0, lists=60).collect():  # isotropic: nearly all lists are probed
        got.setdefault(r.chunk_id, set()).add(r.near)
    assert shuffled(spark) - before < 10 * x.nbytes
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    true = np.argsort(-s, axis=1)[:, :5]
    assert sum(len(got[i] & {ids[j] for j in t}) for i, t in zip(ids, true)) >= 0.99 * 5 * 4000


def test_a_list_longer_than_a_block_is_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((300, 16)).astype("float32")
    ids = [f"c{i:04d}" for i in range(300)]
    got = {}
    for r in N.nearest(frame(spark, [(i, [float(v) for v in r]) for i, r in zip(ids, x)]), 5, 16, lists=1).collect():
        got.setdefault(r.chunk_id, {})[r["rank"]] = r.near
    true = brute(ids, x, 5)
    assert sum(len(set(got[i].values()) & set(true[i])) for i in ids) >= 0.97 * 5 * 300

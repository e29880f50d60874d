import random

import pytest

from tamarack.llm import encoding as E
from tamarack.llm import mixing as M
from tamarack.llm import spans as P
from tamarack.llm import splitting as S

VOCABULARY = f"{E.vocabulary_dir()}/byte_bpe_50k.tiktoken"
ODD = " \n\t　 aé1,。汉'sд́\U0001f600"


# --- pieces


@pytest.mark.parametrize("kind", ["sentences", "lines", "no boundary", "blanks", "cjk", "mixed"])
@pytest.mark.parametrize("n", [4001, 4200, 7801, 20_000])
def test_pieces(kind, n):
    rng = random.Random(n)
    make = {
        "sentences": lambda: "The loader moved 300 tonnes before the pump failed. ", "lines": lambda: "Pump flow: 300 L/min\n", "no boundary": lambda: "x" * 50, "blanks": lambda: "   \n\n", "cjk": lambda: "卡车以七十公里爬上坡道，试验编号一。",
        "mixed": lambda: "".join(rng.choice(ODD) for _ in range(60)),
    }[kind]
    text = ""
    while len(text) < n:
        text += make()
    text = text[:n]
    pieces = S.split(text, 4000, 200)
    assert all(0 < len(p) <= 4000 for _, p in pieces) and len(pieces) > 1
    assert pieces[0][1] + "".join(p[200:] for _, p in pieces[1:]) == text
    assert all(a[1][-200:] == b[1][:200] and text[b[0] : b[0] + 200] == b[1][:200] for a, b in zip(pieces, pieces[1:]))
    if kind in ("sentences", "lines"):
        assert all(p.endswith((". ", "\n")) for _, p in pieces[:-1])


def test_items(spark):
    df = spark.createDataFrame([("page", "1", None), ("page", "2", ""), ("page", "3", "short"), ("chunk", "4", "a. " * 3000), ("chunk", "4", "a. " * 3000), (None, None, "y" * 4000), ("page", "5", "z" * 4001)], "item_kind string, item_id string, text string")
    df = df.withColumn("pieces", df.text).withColumn("start", df.text)
    got = S.split_items(df, 4000, 200).groupBy("item_id").count().collect()
    assert {r.item_id: r["count"] for r in got} == {"3": 1, "4": 6, None: 1, "5": 2}
    assert S.split_items(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        S.split_items(df, 100, 60)


# --- encoding


@pytest.mark.parametrize(("longest", "mean"), [(1 << 16, 1024), (64, 24)])
def test_chunks_encode_as_the_whole(monkeypatch, longest, mean):
    monkeypatch.setattr(E, "LONGEST", longest)
    monkeypatch.setattr(E, "MEAN", mean)
    enc = E.tokenizer(VOCABULARY)
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 400))) for _ in range(300)] + ["x" * 100_000, "汉" * 100_000, " " * 100_000, "a b" * 50_000, "ab1,'s" * 20_000, "", "don't 've\n\n 12 ..."]
    for t, parts in zip(texts, E.chunks(texts)):
        assert "".join(parts) == t
        assert sum((enc.encode_ordinary(p) for p in parts), []) == enc.encode_ordinary(t)


def test_forced_cuts_move_to_the_ends_of_words(monkeypatch):
    monkeypatch.setattr(E, "LONGEST", 100)
    text = "pump300,valve'sx12" * 400
    parts = E.chunks([text])[0]
    enc = E.tokenizer(VOCABULARY)
    assert max(map(len, parts)) <= 250 and sum((enc.encode_ordinary(p) for p in parts), []) == enc.encode_ordinary(text)


def test_a_chunk_of_most_documents_is_spread(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "repeat('This licence covers the manual in full. ', 60) AS text")
    rows = E.encode(df).select("ids").distinct().collect()
    assert len(rows) == 1 and rows[0].ids == E.tokenizer(VOCABULARY).encode_ordinary("This licence covers the manual in full. " * 60)


def test_encode(spark):
    enc = E.tokenizer(VOCABULARY)
    shared = "The loader moved 300 tonnes in 4 hours, then the pump failed. " * 60
    texts = {1: shared, 2: "x" + shared, 3: None, 4: "", 5: " ", 6: "é汉\U0001f600", 7: shared * 30}
    df = spark.createDataFrame([*texts.items(), (1, shared)], "doc_id bigint, text string")
    df = df.withColumn("chunk", df.text).withColumn("place", df.doc_id).withColumn("ids", df.text)
    rows = E.encode(df).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: r.ids for r in rows} == {k: enc.encode_ordinary(v) if v else [] for k, v in texts.items()}
    assert E.encode(df.where("false")).count() == 0


# --- mixing


def documents(spark, sizes):
    rows = [(f"{s}-{i}", s, "word " * n) for s, ns in sizes.items() for i, n in enumerate(ns)]
    return spark.createDataFrame([(i, s, t) for i, (_, s, t) in enumerate(rows)] + [(900_001, None, "word"), (900_002, "a", None), (900_003, "a", "")], "doc_id bigint, source string, text string")


def test_mix(spark):
    rng = random.Random(2)
    docs = documents(spark, {"a": [rng.randint(5, 60) for _ in range(300)], "b": [rng.randint(5, 60) for _ in range(40)], "c": [30] * 10})
    targets = spark.createDataFrame([("m", "a", 0.6, 1), ("m", "b", 0.3, 3), ("m", "c", 0.05, 4), ("m", "gone", 0.05, 2), ("n", "b", 1.0, 2), ("e", "gone", 1.0, 1)], "mix_name string, source string, target_share double, max_repeats int")
    copies, shares = M.mix(docs, targets)
    s = {(r.mix_name, r.source): r for r in shares.collect()}
    assert len(s) == 6 and s["m", "gone"].reached_share == 0 and s["e", "gone"].tokens == 0
    for k in "abc":
        r = s["m", k]
        assert abs(r.reached_share - r.effective_share) < 0.02 and r.effective_share == pytest.approx(r.target_share / 0.95)
    assert s["n", "b"].reached_share == 1 and s["n", "b"].copies == 80
    most = {(r.mix_name, r.source): r.m for r in copies.groupBy("mix_name", "source").agg({"copies": "max"}).toDF("mix_name", "source", "m").collect()}
    assert most["m", "a"] <= 1 and most["m", "b"] <= 3 and most["m", "c"] <= 4
    assert copies.where("source is null or tokens = 0").count() == 0
    again = {(r.mix_name, r.doc_id, r.copies) for r in M.mix(docs, targets)[0].collect()}
    assert again == {(r.mix_name, r.doc_id, r.copies) for r in copies.collect()}


def test_newton_keeps_tokens_and_documents(spark):
    counts = spark.createDataFrame([(i, "a", 1 + i % 50) for i in range(1000)], "doc_id bigint, source string, tokens bigint")
    hist = counts.groupBy("source", "tokens").count().withColumnRenamed("count", "docs")
    total = sum(1 + i % 50 for i in range(1000))
    # asked for other sizes than the source has: the rates must tilt
    want_docs, want_tokens = 400.0, 0.5 * total
    (a, b) = M._solve(hist, {("m", "a"): (want_docs, want_tokens, 1.0, total / 1000, 0.4)})["m", "a"]
    import math

    rates = [min(1.0, math.exp(a + b * (1 + i % 50) / (total / 1000))) for i in range(1000)]
    assert b > 0 and sum(rates) == pytest.approx(want_docs, rel=1e-6) and sum(r * (1 + i % 50) for i, r in enumerate(rates)) == pytest.approx(want_tokens, rel=1e-6)


def test_what_rounding_misses_tilts_the_rates(spark, monkeypatch):
    rng = random.Random(3)
    docs = documents(spark, {**{s: [int(20 * 1.08 ** rng.randint(0, 40)) for _ in range(50)] for s in "abcd"}, "z": [40] * 300})
    targets = spark.createDataFrame([*(("m", s, 0.1, 3) for s in "abcd"), ("m", "z", 0.6, 1)], "mix_name string, source string, target_share double, max_repeats int")
    counts = M.token_counts(docs, VOCABULARY).localCheckpoint()

    def missed():
        planned = M.plan(counts, targets)
        got = {r.source: r.t for r in M._rounded(counts, spark.createDataFrame(planned, M.PLAN)).selectExpr("source", "copies * tokens as t").groupBy("source").sum("t").toDF("source", "t").collect()}
        return sum(abs(got[s] / (got["z"] / 6) - 1) for s in "abcd"), [r[6] for r in planned]

    now, tilts = missed()
    monkeypatch.setattr(M, "ROUNDS", 0)
    flat, none = missed()
    assert any(tilts) and not any(none) and now < 0.8 * flat


def test_rates_that_do_not_converge_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(M, "ITERATIONS", 0)
    docs = documents(spark, {"a": [10, 200, 3000] * 20, "b": [50] * 60})
    targets = spark.createDataFrame([("m", "a", 0.2, 2), ("m", "b", 0.8, 1)], "mix_name string, source string, target_share double, max_repeats int")
    with pytest.raises(RuntimeError, match="converged"):
        M.mix(docs, targets, VOCABULARY)


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("m", "a", 1.0, 1)], "mix_name string, source string, target_share double, max_repeats int")
    copies, shares = M.mix(docs, targets)
    assert copies.count() == 0 and shares.first()["tokens"] == 0
    assert M.mix(docs, targets.where("false"))[1].count() == 0


# --- spans


def brute(texts, least):
    seen = {}
    for k, t in texts.items():
        for p in range(len(t or "") - least + 1):
            seen.setdefault(t[p : p + least], set()).add((k, p))
    pairs, cover = set(), {}
    for hits in seen.values():
        ids = sorted({k for k, _ in hits})
        pairs |= {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]}
        if len(ids) > 1:
            for k, p in hits:
                cover.setdefault(k, set()).update(range(p, p + least))
    return pairs, {k: len(v) for k, v in cover.items()}


@pytest.mark.parametrize("classes", [64, 1])
@pytest.mark.parametrize(("seed", "least", "alphabet"), [(1, 40, "abcdefgh "), (2, 40, "ab"), (3, 41, "a"), (4, 200, "abcdefghij é汉"), (5, 40, "abcdef. \n"), (6, 60, ["The loader moved ore. ", "Pump\n", "flow ", "卡车爬坡。", "at nine; "])])
def test_spans_against_all_substrings(spark, seed, least, alphabet, classes, monkeypatch):
    monkeypatch.setattr(P, "CLASSES", classes)  # 1: every repeated unit is a crowd
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [text(rng.randint(least - 5, 2 * least)) for _ in range(5)]
    texts = {}
    for i in range(1, 30):
        parts = [text(rng.randint(0, least)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages) if rng.random() < 0.7 else "")
        texts[i] = "".join(parts)
    texts |= {40: texts[3], 41: texts[3], 42: None, 43: "", 44: text(least), 45: text(5)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    df = df.withColumn("digest", df.text).withColumn("at", df.doc_id)
    pairs, cover = brute(texts, least)
    got = [tuple(r) for r in P.shared_pairs(df, least).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    portion = {r.doc_id: r for r in P.shared_portion(df, least).collect()}
    assert {k: r.shared_chars for k, r in portion.items() if r.shared_chars} == cover
    assert portion[42].portion == 0 and portion[43].spans == []


def test_spans_of_repeated_rows_and_nothing(spark):
    t = "".join(random.Random(9).choice("abcdef") for _ in range(500))
    df = spark.createDataFrame([(1, t), (1, t), (2, "x" + t), (3, t)], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in P.shared_pairs(df).collect()) == [(1, 2), (1, 3), (2, 3)]
    assert P.shared_pairs(df.where("false")).count() == 0 and P.shared_portion(df.where("false")).count() == 0
    spans = {(r.doc_id, r.start, r.length, r.earlier) for r in P.shared_spans(df).collect()}
    assert spans == {(1, 0, 500, False), (2, 1, 500, True), (3, 0, 500, True)}


def test_lines_find_spans_and_runs_what_lines_cannot(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    sentences = lambda n: " ".join(" ".join(word() for _ in range(8)).capitalize() + "." for _ in range(n))
    shared, bare = sentences(8), "".join(word() for _ in range(60))
    df = spark.createDataFrame([(1, sentences(3) + " " + shared + " " + sentences(2)), (2, sentences(4) + "\n" + shared + "\n" + sentences(2)), (3, word() + bare + word()), (4, sentences(2) + bare)], "doc_id bigint, text string")
    pairs = lambda **k: {tuple(r) for r in P.Shared(df, 200, **k).pairs().collect()}
    assert pairs() == {(1, 2), (3, 4)} and pairs(runs=False) == {(1, 2)} and pairs(lines=False) == {(1, 2), (3, 4)}


def test_the_first_occurrence_stays(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh .") for _ in range(n))
    p, q = text(300), text(250)
    texts = {1: text(50) + p + text(40), 2: "A" + p + "B" + q + "C", 3: q + "D" + p, 4: None, 5: "", 6: text(400)}
    texts[7] = texts[6]
    got = {r.doc_id: r for r in P.without_repeats(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert {k: r.text for k, r in got.items()} == {1: texts[1], 2: "AB" + q + "C", 3: "D", 4: None, 5: "", 6: texts[6], 7: ""}
    assert [tuple(x) for x in got[2].removed] == [(1, 300)] and [tuple(x) for x in got[3].removed] == [(0, 250), (251, 300)]


def test_a_passage_in_thousands_of_documents(spark):
    rng = random.Random(5)
    passage = "This licence covers the use of the manual in mines and depots of all kinds. Copies may be made for crews that work on site and for no other purpose at all. The makers give no warranty of any kind here."
    df = spark.createDataFrame([(i, f"{rng.random()} {i} " * 9 + passage + f" {i} {rng.random()}" * 9) for i in range(3000)], "doc_id bigint, text string")
    got = P.shared_portion(df).select("shared_chars").distinct().collect()
    assert len(got) <= 12 and min(r.shared_chars for r in got) >= len(passage)  # no pair of surroundings is compared
    assert P.without_repeats(df).where("size(removed) > 0").count() == 2999

"""Mixing sources to target shares of the tokens, by entropy balancing.

Every document of a source gets a rate exp(a + b * size), at most the source's cap, that
is closest in entropy to taking each once, subject to the source's tokens (its share of
the total) and to its number of documents (so that short texts aren't favoured). Newton's
method solves the convex dual: each iteration is one distributed aggregation over a
histogram of sizes, which is built with partial sums; the driver holds two numbers per
row of the target table. Rates are rounded to copies systematically along the sizes, in
buckets of bounded length. Flat rates solve the first problem; what rounding them misses
of a source's tokens is asked for again with the number of copies that it gave, which tilts
the rates by size; of some rounds those rates are kept whose copies come nearest to the share.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .encoding import tokenizer, vocabulary_dir

ITERATIONS, CLOSE, BUCKET = 60, 1e-9, 10_000
#: Rounds in which what rounding missed is asked for again, Newton steps in one, and the part of its tokens that a source may miss without another.
ROUNDS, STEPS, NEAR = 4, 12, 1e-3


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    enc = tokenizer(path)
    for b in batches:
        n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "tokens"])


def token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, tokens); null and empty texts have none."""
    path = path or os.path.join(vocabulary_dir(), "byte_bpe_50k.tiktoken")
    return documents.select("doc_id", "source", "text").mapInArrow(lambda it: _counted(it, path), "doc_id bigint, source string, tokens bigint")


def _solve(hist: DataFrame, goals: dict[tuple[str, str], tuple[float, float, float, float, float]], most: int | None = None) -> dict[tuple[str, str], tuple[float, float]]:
    """(a, b) of each (mix, source); goals: documents and tokens wanted, cap, mean size, rate to start from. One aggregation over the histogram an iteration; rates that don't converge are an error, or left out where ``most`` names the number of iterations, and never used."""
    spark = hist.sparkSession
    par = {k: np.array([np.log(start), 0.0]) for k, (_, _, _, _, start) in goals.items()}
    todo = set(goals)
    for _ in range(ITERATIONS if most is None else most):
        if not todo:
            break
        rows = [(m, s, float(par[m, s][0]), float(par[m, s][1]), goals[m, s][2], goals[m, s][3]) for m, s in sorted(todo)]
        now = F.broadcast(spark.createDataFrame(rows, "mix_name string, source string, a double, b double, cap double, mean double"))
        x = F.col("tokens") / F.col("mean")
        w = F.exp(F.least(F.col("a") + F.col("b") * x, F.lit(60.0)))
        free = F.when(w < F.col("cap"), F.col("docs") * w).otherwise(0.0)
        all_ = F.col("docs") * F.least(w, F.col("cap"))
        sums = hist.join(now, "source").groupBy("mix_name", "source").agg(
            F.sum(all_).alias("s0"), F.sum(all_ * x).alias("s1"), F.sum(free).alias("f0"), F.sum(free * x).alias("f1"), F.sum(free * x * x).alias("f2")
        )
        for r in sums.collect():  # as many rows as the target table
            k = (r.mix_name, r.source)
            docs, tokens, _, mean, _ = goals[k]
            gap = np.array([docs - r.s0, tokens / mean - r.s1])
            if np.abs(gap).max() <= CLOSE * max(1.0, docs):
                todo.discard(k)
                continue
            hess = np.array([[r.f0, r.f1], [r.f1, r.f2]]) + 1e-12 * np.eye(2) * (1 + r.f2)
            step = np.linalg.lstsq(hess, gap, rcond=1e-10)[0]
            par[k] = par[k] + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    if todo and most is None:
        raise RuntimeError(f"rates of {sorted(todo)} haven't converged in {ITERATIONS} iterations")
    return {k: (float(v[0]), float(v[1])) for k, v in par.items() if k not in todo}


def plan(counts: DataFrame, targets: DataFrame, total_tokens: dict[str, float] | None = None) -> list[tuple]:
    """Rows (mix, source, share, effective share, cap, a, b, mean size, buckets) for the target table's rows.

    A mix's total is the largest at which every source that has tokens meets its share within
    its cap, unless ``total_tokens`` gives it; then sources fall short where their cap binds.
    The shares of sources without tokens go to the others in proportion.
    """
    hist = materialize(counts.where("source is not null and tokens > 0").groupBy("source", "tokens").agg(F.count("*").alias("docs")), "sizes")
    have = {r.source: (r.docs, r.tokens) for r in hist.groupBy("source").agg(F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.col("tokens")).alias("tokens")).join(F.broadcast(targets.select("source").distinct()), "source", "left_semi").collect()}
    rows = targets.where("mix_name is not null and source is not null").groupBy("mix_name", "source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("cap")).collect()
    mixes: dict[str, list] = {}
    for r in rows:
        mixes.setdefault(r.mix_name, []).append((r.source, float(r.share or 0), float(r.cap or 0)))
    goals, fixed, known = {}, {}, []
    for mix, sources in mixes.items():
        live = [(s, share, cap) for s, share, cap in sources if s in have and share > 0 and cap > 0]
        whole = sum(share for _, share, _ in live)
        total = (total_tokens or {}).get(mix) or min((cap * have[s][1] / (share / whole) for s, share, cap in live), default=0.0)
        for s, share, cap in sources:
            if (s, share, cap) not in live:
                known.append((mix, s, share, 0.0, cap))
                continue
            docs, tokens = have[s]
            want = total * share / whole
            known.append((mix, s, share, share / whole, cap))
            if want >= cap * tokens * (1 - 1e-9):
                fixed[mix, s] = (60.0, 0.0)  # every document up to the cap
            else:
                goals[mix, s] = (want / tokens * docs, want, cap, tokens / docs, min(want / tokens, cap * 0.999))
    solved = _solve(hist, goals) | fixed

    def rows_of(rates):
        return [row(m, s, share, eff, cap, rates) for m, s, share, eff, cap in known]

    row = lambda m, s, share, eff, cap, rates: (m, s, share, eff, int(cap), *rates.get((m, s), (-1e9, 0.0)), have[s][1] / have[s][0] if s in have else 1.0, max(1, have[s][0] // BUCKET) if s in have else 1)
    aims, missed, open_ = {k: np.array(g[:2]) for k, g in goals.items()}, {k: np.inf for k in goals}, dict(goals)
    tried = dict(solved)
    for n in range(ROUNDS + 1):
        if not open_:
            break
        now = counts.sparkSession.createDataFrame([r for r in rows_of(tried) if r[:2] in open_], PLAN)
        sums = _rounded(counts, now).groupBy("mix_name", "source").agg(F.sum("copies").alias("docs"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens"))
        got = {(r.mix_name, r.source): np.array([r.docs, r.tokens], float) for r in sums.collect()}  # as many rows as the target table
        for k in list(open_):
            gap = np.array(goals[k][:2]) - got.get(k, 0.0)
            if (miss := abs(gap[1]) / goals[k][1]) < missed[k]:
                missed[k], solved[k] = miss, tried[k]
            # as many documents as were got, so that their number doesn't jump, of other sizes
            aims[k] = np.array([goals[k][0] - gap[0], aims[k][1] + gap[1]])
            if missed[k] <= NEAR or (aims[k] <= 0).any():
                del open_[k]
        if n < ROUNDS and open_:
            again = _solve(hist, {k: (*map(float, aims[k]), *goals[k][2:]) for k in open_}, STEPS)
            open_ = {k: g for k, g in open_.items() if k in again}
            tried = {**tried, **again}
    return rows_of(solved)


PLAN = "mix_name string, source string, target_share double, effective_share double, max_repeats int, a double, b double, mean double, buckets bigint"


def _rounded(counts: DataFrame, planned: DataFrame) -> DataFrame:
    """(mix_name, doc_id, source, tokens, copies >= 1) by the rates of planned."""
    rate = F.least(F.exp(F.least(F.col("a") + F.col("b") * F.col("tokens") / F.col("mean"), F.lit(60.0))), F.col("max_repeats").cast("double"))
    rated = counts.where("tokens > 0").join(F.broadcast(planned), "source").withColumn("rate", rate).where("rate > 0")
    whole = F.floor(F.col("rate") + 1e-9)
    h = F.xxhash64("mix_name", "doc_id")
    rated = rated.withColumn("whole", whole).withColumn("rest", F.greatest(F.col("rate") - whole, F.lit(0.0))).withColumn("h", h).withColumn("bucket", F.pmod(h, F.col("buckets")))
    # systematic rounding: a document gets one more where the running sum of the rests passes a whole number
    along = Window.partitionBy("mix_name", "source", "bucket").orderBy("tokens", "h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.sum("rest").over(along) + F.lit(0.5)
    copies = (F.col("whole") + F.when(F.floor(run) > F.floor(run - F.col("rest")), 1).otherwise(0)).cast("int")
    return rated.select("mix_name", "doc_id", "source", "tokens", copies.alias("copies")).where("copies > 0")


def mix(documents: DataFrame, targets: DataFrame, path: str | None = None, total_tokens: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) of documents(doc_id, source, text) mixed to targets(mix_name, source, target_share, max_repeats).

    copies: (mix_name, doc_id, source, tokens, copies >= 1); shares: one row per row of the
    targets with documents, copies, tokens, effective_share and reached_share, zeros where a
    source doesn't exist. Documents without source or tokens belong to no mix; repeated rows
    of a document are documents of their own. Empty tables give empty results.
    """
    spark = documents.sparkSession
    counts = materialize(token_counts(documents, path), "tokens")
    planned = spark.createDataFrame(plan(counts, targets, total_tokens), PLAN)
    chosen = materialize(_rounded(counts, planned), "copies")
    got = chosen.groupBy("mix_name", "source").agg(F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens"))
    sums = got.groupBy("mix_name").agg(F.sum("tokens").alias("total"))
    shares = (
        planned.select("mix_name", "source", "target_share", "effective_share", "max_repeats")
        .join(got, ["mix_name", "source"], "left")
        .join(sums, "mix_name", "left")
        .select("mix_name", "source", "target_share", "effective_share", "max_repeats", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("documents", "copies", "tokens")], F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("reached_share"))
    )
    return chosen, shares

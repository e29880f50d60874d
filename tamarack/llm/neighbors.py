"""The k most similar vectors of every vector, by an adaptive scan of dimensions.

Unit vectors are partitioned into lists around centroids (fitted on a bounded sample;
every vector is in a list). A query probes the lists nearest to it; how many is set by
measurement: for a bounded sample of queries the true neighbours are searched among all
vectors, and the smallest number of lists that holds the wanted share of them is taken.
Inside a list vectors are compared in column blocks after a random rotation: the distance
over the first columns estimates the whole one, and a candidate is abandoned as soon as
a test rejects that it could still be among the k nearest; the bound comes from the
query's own list, which is met first. Survivors are compared in full, in double precision.

Equal vectors are one vector with a list of ids of which no more than k + 1 can matter.
Lists are gathered into blocks of bounded size (a longer list is split), which are stored
once in the shared folder. A task takes a pack of blocks as queries and reads one after
the other the blocks that they probe, so that no query or vector is shuffled once for
each block that it meets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, stored, tune

#: Vectors that centroids are fitted on, queries that the number of probes is measured with, most vectors in a block, most queries in a pack.
FIT_ROWS, MEASURE_ROWS, BLOCK_ROWS, PACK_ROWS = 16_384, 256, 4096, 8192
#: Vectors that a block may be cut down to so that all cores have one, and pairs that are compared at once.
LEAST_ROWS, CELLS = 512, 1 << 21
#: Width of a column block, and the significance of the test that abandons candidates.
COLUMNS, EPSILON = 16, 2.1
#: What squared distances of unit vectors lose in 4-byte floats is less.
SLACK = 1e-5
MOST_LISTS = 2048


def usable(chunks: DataFrame, dims: int = 64) -> DataFrame:
    """(id, e) of vectors with ``dims`` finite numbers, not all zero; e is the vector as 4-byte floats."""
    v = F.col("embedding").cast("array<float>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = chunks.where(F.col("chunk_id").isNotNull() & (F.size("embedding") == dims) & finite & F.exists(v, lambda x: x != 0))

    def pack(batches):
        for b in batches:
            flat = np.ascontiguousarray(b.column(1).flatten().to_numpy(zero_copy_only=False), np.float32) + np.float32(0)  # no -0.0
            rows = flat.reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "e"])

    return good.select("chunk_id", v.alias("embedding")).mapInArrow(pack, "id string, e binary")


@functools.cache
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(64).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def unit(e: list[bytes] | bytes, dims: int) -> np.ndarray:
    x = np.frombuffer(e if isinstance(e, bytes) else b"".join(e), np.float32).reshape(-1, dims).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(x: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit vectors by k-means on the sphere."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        empty = np.bincount(own, minlength=lists) == 0
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.maximum(norm, 1e-30), c)
    return c


def top(sims: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row, equal similarities by id; ids are sorted. Returns (columns, similarities)."""
    if sims.shape[1] > 4 * k:
        at = np.argpartition(-sims, 2 * k, axis=1)[:, : 2 * k + 1]
        kth = -np.sort(-np.take_along_axis(sims, at, 1), axis=1)[:, k - 1 : k]
        if ((sims >= kth).sum(1) > 2 * k + 1).any():  # many equal ones
            at = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * k + 1]
        at = np.sort(at, axis=1)
    else:
        at = np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    s = np.take_along_axis(sims, at, 1)
    order = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(at, order, 1), np.take_along_axis(s, order, 1)


def _scan_list(q, x, qq, xx, bound):
    """(i, j) of the queries and a list's vectors that no test rejects.

    q, x: rotated vectors as 4-byte floats; qq, xx: their squared norms by column block;
    bound: the squared distance of each query's kth so far. What passes all tests has a
    distance within the bound but for the rounding of 4-byte floats, which SLACK allows for.
    """
    dims = q.shape[1]
    dist, alive = np.zeros((len(q), len(x)), np.float32), None
    for n, d in enumerate(range(COLUMNS, dims + COLUMNS, COLUMNS)):
        a, b = q[:, d - COLUMNS : d], x[:, d - COLUMNS : d]
        most = bound + SLACK if d >= dims else bound * (d / dims) * (1 + EPSILON / np.sqrt(d)) ** 2 + SLACK
        most = most.astype(np.float32)
        if alive is None:
            part = a @ b.T
            part *= -2
            part += qq[:, n, None]
            part += xx[None, :, n]
            dist += part
            ok = dist <= most[:, None]
            if d >= dims or np.count_nonzero(ok) * 8 < ok.size:
                alive = np.nonzero(ok)
                dist = dist[alive]
        else:
            i, j = alive
            dist = dist + qq[i, n] + xx[j, n] - 2 * np.einsum("nd,nd->n", a[i], b[j])
            ok = dist <= most[i]
            alive, dist = (i[ok], j[ok]), dist[ok]
    return alive


def _merge(best_s, best_i, i, s, near):
    """Put candidates (query, similarity, id) among the best of their queries, equal similarities by id."""
    k = best_s.shape[1]
    rows, who = np.unique(i, return_inverse=True)
    who = np.concatenate((np.repeat(np.arange(len(rows)), k), who))
    sims, ids = np.concatenate((best_s[rows].ravel(), s)), np.concatenate((best_i[rows].ravel(), near))
    order = np.lexsort((-sims, who))
    w, v = who[order], sims[order]
    if ((w[1:] == w[:-1]) & (v[1:] == v[:-1]) & np.isfinite(v[1:])).any():
        order = np.lexsort((pd.factorize(ids, sort=True)[0], -sims, who))
    at = order[np.searchsorted(w, np.arange(len(rows)))[:, None] + np.arange(k)]
    best_s[rows], best_i[rows] = sims[at], ids[at]


def _read(folder: str, group: int, part: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ids in order, lists and vectors of a stored block; nothing where it holds no row."""
    fs, path = pafs.FileSystem.from_uri(folder)
    found = fs.get_file_info(pafs.FileSelector(f"{path}/group={group}/part={part}", allow_not_found=True))
    tables = [pq.ParquetFile(fs.open_input_file(f.path)).read() for f in found if f.path.endswith(".parquet")]
    if not tables:
        return np.zeros(0, object), np.zeros(0, np.int32), []
    t = pa.concat_tables(tables).combine_chunks()
    ids = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in t["tid"].chunks]).astype(object)
    lists = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in t["tlist"].chunks])
    e = [v for c in t["te"].chunks for v in c.flatten().to_pylist()]
    order = np.argsort(ids, kind="stable")
    return ids[order], lists[order], [e[n] for n in order]


def _search(units: list[tuple[int, int]], blocks: dict[int, tuple[np.ndarray, int]], folder: str, centroids: np.ndarray, probes: int, dims: int, k: int) -> pd.DataFrame:
    """The k best of the vectors of some blocks among those of the lists that each probes: (id, near, sim)."""
    rot = rotation(dims)
    turned = lambda v: (v @ rot).astype(np.float32)
    squares = lambda v: np.stack([(c * c).sum(1) for c in (v[:, d : d + COLUMNS] for d in range(0, dims, COLUMNS))], axis=1)
    parts = [_read(folder, g, p) for g, p in units]
    qid = np.concatenate([i for i, _, _ in parts])
    if not len(qid):
        return pd.DataFrame({"id": [], "near": [], "sim": []})
    home = np.bincount(np.concatenate([l for _, l, _ in parts]), minlength=len(centroids))
    q = unit([v for _, _, e in parts for v in e], dims)
    probed = np.zeros((len(q), len(centroids)), bool)
    for at in range(0, len(q), 1024):
        near = np.argsort(-(q[at : at + 1024] @ centroids.T), axis=1, kind="stable")[:, :probes]
        np.put_along_axis(probed[at : at + 1024], near, True, 1)
    qr = turned(q)
    qq = squares(qr)
    best_s, best_i = np.full((len(q), k), -np.inf), np.full((len(q), k), "", object)
    asked = probed.sum(0)
    # the blocks that the queries come from stand first, so that the others meet a bound
    for g in sorted(blocks, key=lambda g: -int(home[blocks[g][0]].sum())):
        if not asked[blocks[g][0]].any():
            continue
        for part in range(blocks[g][1]):
            xid, xl, e = _read(folder, g, part)
            if not len(xid):
                continue
            x = unit(e, dims)
            xr = turned(x)
            xx = squares(xr)
            waiting = []
            for l in np.unique(xl):
                cols, rows = np.flatnonzero(xl == l), np.flatnonzero(probed[:, l])
                for at in range(0, len(rows), step := max(1, CELLS // len(cols))):
                    r = rows[at : at + step]
                    full = np.isfinite(best_s[r, -1])
                    new, old = r[~full], r[full]
                    if len(new):
                        sims = q[new] @ x[cols].T
                        sims[qid[new][:, None] == xid[cols][None, :]] = -np.inf
                        c, s = top(sims, None, k)
                        n, m = np.nonzero(np.isfinite(s))
                        i, j = new[n], cols[c[n, m]]
                        _merge(best_s, best_i, i, np.einsum("nd,nd->n", q[i], x[j]), xid[j])
                    if len(old):
                        i, j = _scan_list(qr[old], xr[cols], qq[old], xx[cols], 2 - 2 * best_s[old, -1])
                        waiting.append((old[i], cols[j]))
            if waiting:
                i, j = (np.concatenate(w) for w in zip(*waiting))
                other = qid[i] != xid[j]
                i, j = i[other], j[other]
                s = np.einsum("nd,nd->n", q[i], x[j])
                ok = s >= best_s[i, -1]
                if ok.any():
                    _merge(best_s, best_i, i[ok], s[ok], xid[j[ok]])
    n, c = np.nonzero(np.isfinite(best_s))
    return pd.DataFrame({"id": qid[n], "near": best_i[n, c], "sim": best_s[n, c]})


def _bisect(c: np.ndarray, sizes: np.ndarray, lists: np.ndarray, most: int, out: list) -> None:
    """Lists that lie together, in groups of at most ``most`` vectors (or one list)."""
    if len(lists) == 1 or sizes[lists].sum() <= most:
        out.append(lists)
        return
    x = c[lists] - c[lists].mean(0)
    along = x @ np.linalg.svd(x, full_matrices=False)[2][0]
    order = lists[np.argsort(along, kind="stable")]
    half = int(np.clip(np.searchsorted(np.cumsum(sizes[order]), sizes[order].sum() / 2) + 1, 1, len(order) - 1))
    _bisect(c, sizes, order[:half], most, out)
    _bisect(c, sizes, order[half:], most, out)


def nearest(chunks: DataFrame, k: int = 5, dims: int = 64, recall: float = 0.998, lists: int | None = None) -> DataFrame:
    """(chunk_id, near, sim, rank): the k most similar other chunks of every usable chunk, equal similarities by chunk_id.

    ``recall`` is the wanted share of true neighbours, see the module; ids must be unique.
    Vectors that are null, empty, of another length, all zero or hold NaN take no part.
    Equal vectors are each other's neighbours at similarity 1. Fewer than k + 1 usable
    vectors have all the others; an empty table gives an empty result.
    """
    spark = tune(chunks.sparkSession)  # packs travel in batches of bounded bytes
    all_ = materialize(usable(chunks, dims), "vectors")
    rank = F.dense_rank().over(Window.partitionBy("e").orderBy("id"))  # a row that came twice counts once
    few = all_.withColumn("n", rank).where(F.col("n") <= k + 1)
    heads = materialize(few.groupBy("e").agg(F.array_sort(F.collect_set("id")).alias("ids")).select(F.element_at("ids", 1).alias("id"), "e", "ids"), "heads")
    n = heads.count()
    if n == 0:
        return spark.createDataFrame([], "chunk_id string, near string, sim double, rank int")
    sample = lambda most: [bytes(r.e) for r in heads.select("e").where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // most))) == 0).limit(2 * most).collect()]
    lists = min(lists or max(1, round(np.sqrt(n) / 1.5)), MOST_LISTS)
    x = unit(sample(FIT_ROWS), dims) if n > 1 else unit(sample(1), dims)
    lists = min(lists, max(1, len(x) // 4))
    centroids = fit(x, lists)
    probes = measured_probes(heads, centroids, k, dims, recall, n)

    def assign(batches):
        for b in batches:
            v = unit(b["e"].map(bytes).tolist(), dims)
            yield pd.DataFrame({"id": b["id"], "e": b["e"], "list": (v @ centroids.T).argmax(1).astype("int32")})

    listed = heads.select("id", "e").mapInPandas(assign, "id string, e binary, list int")
    sizes = np.zeros(lists, np.int64)
    for r in listed.groupBy("list").count().collect():  # one row per list
        sizes[r["list"]] = r["count"]
    cores = spark.sparkContext.defaultParallelism
    rows_a_block = int(np.clip(n // (4 * cores), LEAST_ROWS, BLOCK_ROWS))
    groups: list[np.ndarray] = []
    _bisect(centroids, sizes, np.arange(lists), rows_a_block, groups)
    blocks = {g: (m, int(max(1, -(-int(sizes[m].sum()) // rows_a_block)))) for g, m in enumerate(groups)}
    where = F.broadcast(spark.createDataFrame([(int(l), g, parts) for g, (m, parts) in blocks.items() for l in m], "list int, group int, parts int"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    vectors = listed.join(where, "list").select("id", "e", "list", "group", part)
    gathered = vectors.groupBy("group", "part").agg(F.collect_list(F.struct("id", "list", "e")).alias("t"))
    folder = stored(gathered.select("group", "part", F.col("t.id").alias("tid"), F.col("t.list").alias("tlist"), F.col("t.e").alias("te")), "blocks", "group", "part")
    # queries are packs of blocks that lie together; a task reads the blocks that its pack probes from the shared folder
    packs: list[list[tuple[int, int]]] = []
    most, held = max(rows_a_block, min(PACK_ROWS, n // (3 * cores))), np.inf
    for g, (m, parts) in blocks.items():
        for p in range(parts):
            size = sizes[m].sum() / parts
            if held + size > most:
                packs.append([])
                held = 0
            packs[-1].append((g, p))
            held += size

    def search(batches):
        for b in batches:
            for p in b["id"]:
                yield _search(packs[p], blocks, folder, centroids, probes, dims, k)

    # written, so that the planner takes its size from files and not from the few rows of packs
    near = materialize(spark.range(0, len(packs), 1, len(packs)).mapInPandas(search, "id string, near string, sim double"), "near")
    # from vectors to chunks: a neighbour stands for its ids, a vector's own copies come first
    ids = heads.select("id", "ids")
    spread = near.join(ids.select(F.col("id").alias("near"), "ids"), "near").groupBy("id").agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("sim")).alias("s"), i.alias("i"))))).alias("around"))
    copies = ids.select("id", F.transform("ids", lambda i: F.struct(F.lit(-1.0).alias("s"), i.alias("i"))).alias("own"))
    none = F.filter("own", lambda _: F.lit(False))
    pool = copies.join(spread, "id", "left").select("id", F.array_sort(F.concat("own", F.coalesce("around", none))).alias("pool"))
    everyone = all_.join(heads.select(F.col("id").alias("head"), "e"), "e").select(F.col("id").alias("chunk_id"), "head")
    mine = everyone.join(pool, everyone["head"] == pool["id"]).select("chunk_id", F.slice(F.filter("pool", lambda p: p["i"] != F.col("chunk_id")), 1, k).alias("top"))
    return mine.select("chunk_id", F.posexplode("top").alias("r", "p")).select("chunk_id", F.col("p.i").alias("near"), (-F.col("p.s")).alias("sim"), (F.col("r") + 1).alias("rank"))


def true_nearest(vectors: DataFrame, queries: list[bytes], k: int, dims: int) -> np.ndarray:
    """The exact k nearest of a bounded set of queries among all vectors(e): their unit vectors, (queries, k, dims), NaN where there are fewer."""
    q = unit(queries, dims)

    def local(batches):
        kept = None
        for b in batches:
            if not len(b):
                continue
            v = unit(b["e"].map(bytes).tolist(), dims)
            s = q @ v.T
            s[s > 1 - 1e-12] = -np.inf  # itself
            c = min(k, s.shape[1])
            at = np.argpartition(-s, c - 1, axis=1)[:, :c]
            rows = pd.DataFrame({"q": np.repeat(np.arange(len(q), dtype="int32"), c), "sim": np.take_along_axis(s, at, 1).ravel(), "e": b["e"].to_numpy()[at.ravel()]})
            kept = rows if kept is None else pd.concat((kept, rows))
            kept = kept.sort_values("sim", ascending=False).groupby("q").head(k)
        if kept is not None:
            yield kept

    found = vectors.select("e").mapInPandas(local, "q int, sim double, e binary")
    first = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim")))
    out, fill = np.full((len(q), k, dims), np.nan), np.zeros(len(q), int)
    for r in found.withColumn("n", first).where(F.col("n") <= k).collect():  # k rows per sampled query
        if np.isfinite(r.sim):
            out[r.q, fill[r.q]] = unit(bytes(r.e), dims)[0]
            fill[r.q] += 1
    return out


def measured_probes(heads: DataFrame, centroids: np.ndarray, k: int, dims: int, recall: float, n: int) -> int:
    """The fewest lists that hold the share ``recall`` of the true neighbours of a sample of queries."""
    if len(centroids) == 1:
        return 1
    asked = [bytes(r.e) for r in heads.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(max(1, n // MEASURE_ROWS))) == 0).select("e").limit(2 * MEASURE_ROWS).collect()]
    true = true_nearest(heads, asked, k, dims)
    order = np.argsort(-(unit(asked, dims) @ centroids.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    ok = ~np.isnan(true[..., 0])
    if not ok.any():
        return len(centroids)
    own = np.where(ok, (np.nan_to_num(true) @ centroids.T).argmax(-1), 0)
    ranks = np.sort(np.take_along_axis(place, own, 1)[ok])
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1


def pairs(found: DataFrame) -> DataFrame:
    """(chunk_id_a, chunk_id_b), smaller first, of which one is among the nearest of the other."""
    return found.select(F.least("chunk_id", "near").alias("chunk_id_a"), F.greatest("chunk_id", "near").alias("chunk_id_b")).distinct()

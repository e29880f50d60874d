"""Text encoders and exact cosine search."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import tune


def hashing_encoder(dims: int = 256):
    """The encoder that needs no model: hashed word counts of unit length, as array<float>. Any function of (DataFrame, text, out) can take its place."""

    def encode(df: DataFrame, text: str = "text", out: str = "embedding") -> DataFrame:
        base = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        counted = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dims).transform(Tokenizer(inputCol="_text", outputCol="_words").transform(base))
        unit = Normalizer(inputCol="_tf", outputCol="_unit").transform(counted)
        return unit.withColumn(out, vector_to_array("_unit", "float32")).drop("_text", "_words", "_tf", "_unit")

    return encode


def store(chunks: DataFrame, path: str) -> None:
    """Append chunks with their vectors and metadata to a collection, partitioned by brand so that a search's filter reads one folder."""
    chunks.select("chunk_id", "text", "brand", "model", "equipment_type", "source_url", "embedding").write.mode("append").partitionBy("brand").parquet(path)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector is null, of another length, zero or not finite."""
    c = dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
    zero = (dot(a, a) == 0) | (dot(b, b) == 0)
    return F.when((F.size(a) == F.size(b)) & ~zero & ~F.isnan(F.when(zero, F.lit(None)).otherwise(c)), F.when(~zero, c))


def search(chunks: DataFrame, query: list[float], n: int = 10, brand: str | None = None, key: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """The n nearest chunks of a query vector: all columns with distance (1 - cosine), nearest first, equal ones by key. The metadata filter goes before the search."""
    q = F.array(*[F.lit(float(x)) for x in query])
    norm = sum(x * x for x in query) ** 0.5
    v = F.col(vector)
    pool = chunks if brand is None else chunks.where(F.col("brand") == brand)
    own = dot(v, v)
    sim = F.when((F.size(v) == len(query)) & (own > 0), dot(v, q) / (F.sqrt(own) * norm))
    return pool.withColumn("distance", 1 - sim).where(F.col("distance").isNotNull() & ~F.isnan("distance")).orderBy("distance", key).limit(n)


def search_text(chunks: DataFrame, text: str, encode, n: int = 10, brand: str | None = None) -> DataFrame:
    """Encode a text and search."""
    spark = chunks.sparkSession
    q = encode(spark.createDataFrame([(text,)], "text string")).first()["embedding"]
    return search(chunks, [float(x) for x in q], n, brand)


def shown(found: DataFrame) -> DataFrame:
    """What a search prints: score with three decimals and the first 200 characters."""
    return found.select("chunk_id", F.round(1 - F.col("distance"), 3).alias("score"), F.substring("text", 1, 200).alias("excerpt"), *[c for c in ("brand", "model", "source_url") if c in found.columns])


def knn(queries: DataFrame, base: DataFrame, n: int = 10, key: str = "vec_id", vector: str = "embedding", dims: int = 64, block: int = 2048) -> DataFrame:
    """(query, near, similarity, rank): the n most similar rows of ``base`` for every query, exactly; equal ones by key, which is a number.

    Queries and rows are packed into blocks of bounded size and each pair of blocks is one
    product of matrices, of which only the n best of a query leave the task. Vectors that are
    null, of another length, zero or not finite take no part; a query isn't its own neighbour.
    """
    import numpy as np
    import pandas as pd

    tune(base.sparkSession)  # packs travel in batches of bounded bytes

    def packs(df: DataFrame, name: str, salt: int) -> DataFrame:
        v = F.col(vector).cast("array<float>")
        good = df.where((F.size(vector) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
        part = F.pmod(F.xxhash64(key, F.lit(salt)), F.ceil(F.lit(max(1, good.count())) / block)).alias("part")
        return good.select(F.col(key).cast("bigint").alias("k"), v.alias("v"), part).groupBy("part").agg(F.collect_list("k").alias(f"{name}k"), F.flatten(F.collect_list("v")).alias(f"{name}v")).drop("part")

    def run(batches):
        for b in batches:
            for qk, qv, xk, xv in zip(b["qk"], b["qv"], b["xk"], b["xv"]):
                unit = lambda a: (lambda m: m / np.linalg.norm(m, axis=1, keepdims=True))(np.asarray(a, np.float64).reshape(-1, dims))
                order = np.argsort(np.asarray(xk), kind="stable")
                keys, s = np.asarray(xk)[order], unit(qv) @ unit(xv)[order].T
                s[np.asarray(qk)[:, None] == keys[None, :]] = -np.inf
                at = np.argsort(-s, axis=1, kind="stable")[:, :n]
                sim = np.take_along_axis(s, at, 1)
                q = np.repeat(np.asarray(qk), at.shape[1])
                out = pd.DataFrame({"query": q, "near": keys[at.ravel()], "similarity": sim.ravel()})
                yield out[np.isfinite(out["similarity"])]

    pairs = packs(queries, "q", 1).crossJoin(packs(base, "x", 2)).select("qk", "qv", "xk", "xv")
    found = pairs.mapInPandas(run, "query bigint, near bigint, similarity double")
    best = Window.partitionBy("query").orderBy(F.desc("similarity"), "near")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)

"""Rate limits and caches as analytics over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def calls_in_window(events: DataFrame, key: str, seconds: int = 60, at: str = "ts") -> DataFrame:
    """Adds in_window: the events of a key in the ``seconds`` before and at each event."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    w = Window.partitionBy(key).orderBy("_t").rangeBetween(-seconds * 1_000_000 + 1, 0)
    return events.withColumn("_t", micros).withColumn("in_window", F.count("*").over(w)).drop("_t")


def over_limit(events: DataFrame, key: str, most: int = 20, seconds: int = 60, at: str = "ts") -> DataFrame:
    """Events that would have had to wait under a sliding limit."""
    return calls_in_window(events, key, seconds, at).where(F.col("in_window") > most)


def allowed(urls: DataFrame, robots: DataFrame, now: str, ttl_seconds: int = 3600) -> DataFrame:
    """Addresses that robots(host, path_prefix, allow, fetched_at) let through: the longest matching prefix decides, entries older than the time to live and hosts without entry allow."""
    from ..functions.urls import authority, path

    at = F.lit(now).cast("timestamp")
    fresh = robots.where(F.unix_micros("fetched_at") > F.unix_micros(at) - ttl_seconds * 1_000_000).select("host", "path_prefix", "allow")
    u = urls.withColumn("_h", authority(F.col("url"))).withColumn("_p", F.when(path(F.col("url")) == "", "/").otherwise(path(F.col("url"))))
    rules = fresh.groupBy("host").agg(F.collect_list(F.struct(F.length("path_prefix").alias("n"), "path_prefix", "allow")).alias("_r"))
    j = u.join(rules, u["_h"] == rules["host"], "left").drop("host")
    hit = F.array_max(F.filter("_r", lambda r: F.col("_p").startswith(r["path_prefix"])))
    return j.where(F.coalesce(hit["allow"], F.lit(True))).drop("_h", "_p", "_r")

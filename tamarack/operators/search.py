"""Inventory, query generation, and de-duplication of search results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls

TIERS = ("tier_1", "tier_2", "chinese_brands")
CATEGORIES = ("carguio", "transporte")


def brands(spark: SparkSession, config: dict) -> DataFrame:
    """(seq, tier, key, name, country, site, groups) of a brand configuration, in the order of tiers; the name defaults to the key."""
    rows = []
    for tier in TIERS:
        for key, b in (config.get(tier) or {}).items():
            groups = [(cat, e.get("tipo", ""), [str(x) for x in e.get("series", [])]) for cat in CATEGORIES for e in (b.get("equipos") or {}).get(cat, [])]
            rows.append((len(rows), tier, key, b.get("nombre_completo", key), b.get("pais", ""), b.get("sitio_web", ""), groups))
    return spark.createDataFrame(rows, "seq int, tier string, key string, name string, country string, site string, groups array<struct<category:string,equipment_type:string,series:array<string>>>")


def models(brand_table: DataFrame) -> DataFrame:
    """One row per model of each brand, in the order of the configuration."""
    g = brand_table.select("seq", "tier", "key", "name", F.posexplode("groups").alias("g", "x"))
    return g.select("seq", "tier", "key", "name", "g", F.col("x.category").alias("category"), F.col("x.equipment_type").alias("equipment_type"), F.posexplode("x.series").alias("m", "model"))


def queries(machines: DataFrame, expanded: bool = True, year: str = R.YEARS) -> DataFrame:
    """machines(brand, model, equipment_type, ...) with every template filled in: template_no and query. Null parts are empty."""
    templates = [*R.QUERY_TEMPLATES, *(R.EXPANDED_TEMPLATES if expanded else ())]
    t = machines.sparkSession.createDataFrame(list(enumerate(templates)), "template_no int, template string")
    part = lambda c: F.coalesce(F.col(c), F.lit("")) if c in machines.columns else F.lit("")
    q = F.col("template")
    for name, value in (("brand", part("brand")), ("model", part("model")), ("equipment_type", part("equipment_type")), ("year", F.lit(year))):
        q = F.replace(q, F.lit("{" + name + "}"), value)
    # twenty templates of fixed size: every machine meets each
    return machines.crossJoin(F.broadcast(t)).withColumn("query", q).drop("template")


def first_by_url(results: DataFrame, order: str = "seq") -> DataFrame:
    """The first result of each address, as it is written; rows without address fall out."""
    first = Window.partitionBy("url").orderBy(order)
    return results.where(F.col("url").isNotNull()).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def unseen(results: DataFrame, visited: DataFrame) -> DataFrame:
    """Results whose address isn't among visited(url)."""
    return results.join(visited.select("url").where("url is not null").distinct(), "url", "left_anti").select(*results.columns)


def accept(results: DataFrame, visited: DataFrame | None = None, order: str = "seq", v6: bool = True) -> DataFrame:
    """Results to fetch: not visited, not blocked, safe, first of their address."""
    kept = results if visited is None else unseen(results, visited)
    return first_by_url(kept.where(~urls.is_blocked(F.col("url")) & urls.is_safe(F.col("url"), v6=v6)), order)


def inventory(machines: DataFrame) -> DataFrame:
    """Counts of models by brand and category, by category, by type, by brand, and in all, in one pass over grouping sets."""
    cols = ["brand", "category", "equipment_type"]
    g = machines.groupingSets([["brand", "category"], ["category"], ["equipment_type"], ["brand"], []], *cols)
    level = F.grouping_id(*cols)
    return g.agg(level.cast("int").alias("level"), F.count("*").alias("models"))


def inventory_by_tier(machines: DataFrame) -> DataFrame:
    """(tier, brand, category, models) of machines(tier, brand, category, ...)."""
    return machines.groupBy("tier", "brand", "category").agg(F.count("*").alias("models"))


def search(machines: DataFrame, fetch, visited: DataFrame | None = None, max_results: int = 10) -> DataFrame:
    """Queries of the machines sent through ``fetch`` and accepted: fetch maps a DataFrame with a query column to results (query columns, title, url, snippet, source_engine, seq)."""
    found = fetch(queries(machines), max_results)
    return accept(found, visited)

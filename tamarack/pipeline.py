"""The whole lineage from search results to the warehouse's tables and the report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import config
from .operators import chunks, consensus, curves, html, qa, report, search, specs, vectors, warehouse
from .session import materialize


def scraped(results: DataFrame, fetched: DataFrame, least: int = 100) -> DataFrame:
    """Pages of accepted results: fetched(url, title, text_content, tables) with the brand and model of the first result of each address."""
    first = search.first_by_url(results).select("url", "brand", "model")
    return fetched.join(first, "url").where(F.length("text_content") > least)


def extracted(pages: DataFrame) -> dict[str, DataFrame]:
    """From pages(url, brand, model, text_content, tables): facts per page, the quality report, consensus per machine, and curves."""
    keys = ["brand", "model", "url"]
    base = pages.select(*keys, F.col("text_content").alias("text"), "tables")
    facts = materialize(specs.profile(base, keys), "facts")  # three results are made from them
    report = qa.report(facts, keys)
    passed = qa.check(facts).where("passed").withColumn("source_url", F.col("url"))
    agreed = consensus.consensus(passed.select("brand", "model", "parameter", "value", "unit", "confidence", "source_url", "seq"))
    points = curves.from_tables(base.drop("text")).unionByName(curves.from_text(base.drop("tables")).withColumn("curve_no", F.lit(-1)))
    points = materialize(points, "points")
    valid, curve_report = curves.check(points, ["brand", "model", "url", "curve_no"])
    curve = curves.consensus(valid.withColumn("source_url", F.col("url")).withColumn("curve", F.concat_ws("#", "url", "curve_no")), ["brand", "model"], "curve")
    return {"facts": facts, "report": report, "consensus": agreed, "curves": curve, "curve_report": curve_report}


def embedded(pages: DataFrame, encode=None, size: int = 512, overlap: int = 50) -> DataFrame:
    """Chunks of pages with their vectors."""
    parts = chunks.chunk_words(pages.select("brand", "model", F.col("url").alias("source_url"), F.col("text_content").alias("text")), size, overlap, url="source_url", name=["brand", "model"])
    return (encode or vectors.hashing_encoder())(parts.withColumnRenamed("chunk", "text"))


def persist(store, agreed: DataFrame, curve: DataFrame, sources: DataFrame | None = None, parameters_at: str | None = None) -> DataFrame:
    """Consensus values and curve points into the warehouse, for brands that it knows by name.

    Machines it doesn't have are added; a machine's value of a parameter replaces the stored
    one, its curve the stored curve; fetched addresses are recorded, so that they count as
    visited. Returns the counts written: (table_name, rows).
    """
    spark = agreed.sparkSession
    brands = store.read("brands").select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    known = agreed.select("brand", "model").unionByName(curve.select("brand", "model")).distinct().join(brands, "brand")
    new = known.select("brand_id", "model")
    store.insert_absent("equipment", new, ["brand_id", "model"])
    machines = store.read("equipment").select(F.col("id").alias("equipment_id"), "brand_id", "model").join(brands, "brand_id").drop("brand_id")
    now = F.lit(parameters_at).cast("timestamp") if parameters_at else F.current_timestamp()
    written = []

    def put(table: str, rows: DataFrame, keys: list[str]) -> None:
        rows = materialize(rows, table)  # written once, read for ids, buckets and the count
        top = store.read(table).agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
        store.upsert(table, rows.crossJoin(top).withColumn("id", F.col("_top") + 1 + F.monotonically_increasing_id()).drop("_top"), keys)
        written.append((table, rows.count()))

    facts = agreed.join(machines, ["brand", "model"]).select("equipment_id", "parameter", F.col("best_value").alias("value"), F.col("best_unit").alias("unit"), F.col("final_confidence").alias("confidence"), F.get("sources", F.lit(0)).alias("source_url"), now.alias("extracted_at"))
    put("technical_specs", facts, ["equipment_id", "parameter"])
    points = curve.join(machines, ["brand", "model"]).select("equipment_id", "gear", "speed_kmh", "force_kn", "original_unit", "confidence", "source_url", now.alias("extracted_at"))
    put("rimpull_points", points, ["equipment_id"])
    if sources is not None:
        rows = sources.join(machines, ["brand", "model"]).select("equipment_id", "url", "title", F.sha2("text_content", 256).alias("content_hash"), now.alias("scraped_at"), F.length("text_content").cast("bigint").alias("content_length"))
        put("data_sources", rows.dropDuplicates(["equipment_id", "url"]), ["equipment_id", "url"])
    return spark.createDataFrame(written, "table_name string, rows bigint")


Search = Callable[[DataFrame], DataFrame]
Fetch = Callable[[DataFrame], DataFrame]


def online(spark, settings: dict, keys: dict[str, str]) -> tuple[Search, Fetch]:
    """Search engines and the web, for :func:`run`; an engine without key has no results."""
    import json

    from .sources import search_api, web

    spark.dataSource.register(search_api.SearchSource)

    def find(queries: DataFrame) -> DataFrame:
        asked = json.dumps([r.query for r in queries.select("query").distinct().collect()])  # calls to make, a few thousand
        found = None
        for engine, key in (("google", "GOOGLE_API_KEY"), ("serper", "SERPER_API_KEY")):
            r = spark.read.format("search_api").options(queries=asked, engine=engine, key=keys.get(key, ""), cx=keys.get("GOOGLE_CX", ""), num=settings["search.max_results_per_query"], pause=settings["scraping.request_delay_seconds"]).load()
            found = r if found is None else found.unionByName(r)
        return found

    def fetch(urls: DataFrame) -> DataFrame:
        return web.fetch(urls, agent=settings["scraping.user_agent"], delay=settings["scraping.request_delay_seconds"], timeout=settings["scraping.timeout_seconds"], retries=settings["scraping.max_retries"])

    return find, fetch


def stored(results: DataFrame, pages: DataFrame) -> tuple[Search, Fetch]:
    """The same from tables: results(query, seq, title, url, snippet, source_engine), pages(url, html)."""
    return lambda queries: results.join(queries.select("query").distinct(), "query", "left_semi"), lambda urls: urls.select("url").distinct().join(pages.select("url", "html"), "url")


def run(spark, path: str, machines: DataFrame, find: Search, fetch: Fetch, settings: dict | None = None, brand: str | None = None, fresh: bool = False, out: str | None = None, encode=None) -> dict[str, int]:
    """The whole pipeline: search, fetch, extract, persist, embed and report; returns the run's totals.

    machines: (brand, model, equipment_type, key) to search for; ``brand`` is a name or key,
    and an unknown one is an error. Addresses that the warehouse has sources of are skipped,
    so a run that broke off goes on where it stood; ``fresh`` first clears what is stored
    of the brands. Reports go to ``out`` where it is given. Nothing found is no error.
    """
    settings = settings or config.settings({})
    if brand is not None:
        machines = machines.where((F.col("brand") == brand) | ((F.col("key") == brand) if "key" in machines.columns else F.lit(False)))
        if not machines.head(1):
            raise ValueError(f"unknown brand: {brand}")
    store = warehouse.Warehouse(spark, path)
    store.create()
    key = F.col("key") if "key" in machines.columns else F.col("brand")
    store.insert_absent("brands", machines.select(key.alias("key"), F.col("brand").alias("name")), ["name"])
    if fresh:
        names = machines.select(F.col("brand").alias("name")).distinct()
        for (i,) in store.read("brands").join(names, "name").select("id").collect():  # a row a brand
            store.clear_brand(i)
    visited = materialize(warehouse.visited_urls(store.read("brands"), store.read("equipment"), store.read("data_sources")), "visited")
    asked = materialize(search.queries(machines.select("brand", "model", "equipment_type")), "queries")
    results = materialize(find(asked).join(asked.select("query", "brand", "model").dropDuplicates(["query"]), "query"), "results")
    log = results.groupBy("query", F.col("source_engine").alias("engine")).agg(F.count("url").alias("results_count")).withColumn("executed_at", F.current_timestamp())
    store.append("search_log", log.select("query", "engine", "results_count", "executed_at"))
    order = F.concat_ws(" ", "query", F.lpad(F.col("seq").cast("string"), 9, "0"), "source_engine")
    wanted = materialize(search.accept(results.withColumn("seq", order), visited), "wanted")
    fetched = materialize(fetch(wanted.select("url")), "fetched")
    parsed = html.pages(fetched.where("html is not null").select("url", "html"))
    pages = materialize(scraped(wanted, parsed), "pages")
    made = extracted(pages)
    made["consensus"], made["curves"] = materialize(made["consensus"], "agreed"), materialize(made["curves"], "curves")
    persist(store, made["consensus"], made["curves"], pages)
    parts = embedded(pages, encode, settings["nlp.chunk_size"], settings["nlp.chunk_overlap"]).withColumn("equipment_type", F.lit(None).cast("string"))
    vectors.store(parts, f"{path.rstrip('/')}/vectors")
    if out is not None:
        reported(store, out)
    count = lambda df: df.count()
    return {"queries": count(asked), "results": results.where("url is not null").count(), "accepted": count(wanted), "fetched": fetched.where("html is not null").count(), "pages": count(pages), "facts": count(made["facts"]), "agreed": count(made["consensus"]), "points": count(made["curves"])}


def reported(store: warehouse.Warehouse, out: str, brand: str | None = None) -> str:
    """CSV files, the pivot, summary.json and the page of what is stored; the page's path, "" where there is nothing."""
    import os

    brands, equipment = store.read("brands"), store.read("equipment")
    frame = warehouse.specs_frame(brands, equipment, store.read("technical_specs"))
    points = report.series(warehouse.curves_frame(brands, equipment, store.read("rimpull_points")))
    if brand is not None:
        frame, points = frame.where(F.col("brand") == brand), points.where(F.col("brand") == brand)
    report.write_csv(frame, f"{out}/csv")
    parameters = [r.parameter for r in frame.select("parameter").distinct().orderBy("parameter").collect()]  # columns of the pivot
    report.write_pivot(frame, parameters, f"{out}/csv/pivot")
    os.makedirs(out, exist_ok=True)
    with open(f"{out}/summary.json", "w", encoding="utf-8") as f:
        f.write(report.summary_json(frame))
    return report.html_report(frame, f"{out}/report.html", points=points)

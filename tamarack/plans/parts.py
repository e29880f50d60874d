"""Queries of operators that the lineage is made of, each with SQL of its own; constants are spelled out there."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import curves, html, limits, report, search, specs, vectors, warehouse
from ..session import shared_dir
from ..sources import search_api
from . import reference as Q

query = Q.query


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:10]}"


# --- search


def answer(engine: str, text: str, options: dict) -> dict:
    """What an engine says to a query, made up from the query."""
    link = "https://site.example/" + text.lower().replace(" ", "-")
    items = [{"title": f"{text} #{i}", "link": f"{link}/{i}", "snippet": f"about {text}"} for i in range(2)]
    return {"items" if engine == "google" else "organic": [*items, {"title": "video", "link": "https://www.youtube.com/" + link[20:]}]}


_MODELS = "(SELECT brand, model FROM equipment GROUP BY ALL)"
_ANSWERS = f"""(SELECT q || ' #' || i AS title, 'https://site.example/' || replace(lower(q), ' ', '-') || '/' || i AS url, 'about ' || q AS snippet, i AS seq, q FROM (SELECT brand || ' ' || model AS q FROM {_MODELS} WHERE brand || model IS NOT NULL), (VALUES (0), (1)) v(i)
  UNION ALL SELECT 'video', 'https://www.youtube.com/' || substr('https://site.example/' || replace(lower(q), ' ', '-'), 21), '', 2, q FROM (SELECT brand || ' ' || model AS q FROM {_MODELS} WHERE brand || model IS NOT NULL))"""


def _asked(spark, t, engine: str) -> DataFrame:
    """Every machine asked for once; the queries are as many as machines."""
    spark.dataSource.register(search_api.SearchSource)
    q = [r.q for r in t("equipment").select(F.concat_ws(" ", "brand", "model").alias("q"), F.concat("brand", "model").alias("k")).where("k is not null").select("q").distinct().collect()]
    reader = spark.read.format("search_api").option("queries", json.dumps(sorted(q))).option("engine", engine)
    return reader.option("fetcher", "tamarack.plans.parts:answer").option("calls", len(q) + 1).load()


@query(f"SELECT q AS query, CAST(seq AS INTEGER) AS seq, title, url, snippet, 'google' AS source_engine FROM {_ANSWERS}")
def search_google(spark, t):
    """Results of the one engine's responses."""
    return _asked(spark, t, "google").drop("error")


@query(f"SELECT q AS query, CAST(seq AS INTEGER) AS seq, title, url, snippet, 'serper' AS source_engine FROM {_ANSWERS}")
def search_serper(spark, t):
    """Results of the other engine's responses."""
    return _asked(spark, t, "serper").drop("error")


@query(f"SELECT q AS query, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY q, seq) AS n FROM {_ANSWERS} WHERE url NOT LIKE '%youtube.com%') WHERE n = 1")
def search_brand(spark, t):
    """What one search of all machines would fetch."""
    return search.accept(_asked(spark, t, "google").withColumn("at", F.concat("query", F.lit(" "), F.col("seq").cast("string"))), order="at").select("query", "url")


_CONFIG = {
    "tier_1": {"alfa": {"nombre_completo": "Alfa Works", "pais": "CL", "sitio_web": "https://alfa.example", "equipos": {"carguio": [{"tipo": "Pala", "series": ["A1", "A2"]}], "transporte": [{"tipo": "Camion", "series": [930]}]}}, "vacia": {}},
    "tier_2": {"beta": {"equipos": {"transporte": [{"series": ["B7"]}]}}},
    "chinese_brands": {"gama": {"nombre_completo": "Gama", "equipos": {"carguio": [{"tipo": "Cargador", "series": []}]}}},
}


@query("SELECT * FROM (VALUES ('tier_1', 'alfa', 'Alfa Works', 'CL', 'https://alfa.example'), ('tier_1', 'vacia', 'vacia', '', ''), ('tier_2', 'beta', 'beta', '', ''), ('chinese_brands', 'gama', 'Gama', '', '')) v(tier, key, name, country, site)")
def config_brands(spark, t):
    """The brands of a configuration."""
    return search.brands(spark, _CONFIG).select("tier", "key", "name", "country", "site")


@query("SELECT * FROM (VALUES ('tier_1', 'alfa', 'carguio', 'Pala', 'A1'), ('tier_1', 'alfa', 'carguio', 'Pala', 'A2'), ('tier_1', 'alfa', 'transporte', 'Camion', '930'), ('tier_2', 'beta', 'transporte', '', 'B7')) v(tier, key, category, equipment_type, model)")
def config_models(spark, t):
    """The models of a configuration."""
    return search.models(search.brands(spark, _CONFIG)).select("tier", "key", "category", "equipment_type", "model")


@query("SELECT CASE WHEN brand_id <= 4 THEN 'tier_1' WHEN brand_id <= 8 THEN 'tier_2' ELSE 'chinese_brands' END AS tier, brand, category, count(*) AS models FROM equipment GROUP BY ALL")
def inventory_tiers(spark, t):
    """Models by tier, brand and category."""
    tier = F.when(F.col("brand_id") <= 4, "tier_1").when(F.col("brand_id") <= 8, "tier_2").otherwise("chinese_brands")
    return search.inventory_by_tier(t("equipment").withColumn("tier", tier))


# --- addresses


@query("SELECT url, coalesce(regexp_matches(url, '^https?://') AND NOT regexp_matches(lower(url), '^https?://[^/?#:]*[0-9][^/?#:]*(?:[:/?#]|$)'), false) AS safe FROM data_sources")
def url_resolved(spark, t):
    """Safety with a resolver: here names with digits are taken for private."""
    return t("data_sources").select("url", U.is_safe(F.col("url"), resolver=lambda h: ~h.rlike("[0-9]")).alias("safe"))


_HOSTS = "lower(regexp_extract(url, '^https?://([^/?#]*)', 1))"


@query(
    f"""WITH u AS (SELECT seq, url, {_HOSTS} AS host, CASE WHEN lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)) = '' THEN '/' ELSE regexp_replace(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), ';[^/]*$', '') END AS p FROM search_results WHERE regexp_matches(url, '^https?://')),
    r AS (SELECT DISTINCT host, pre, allow FROM (SELECT {_HOSTS} AS host FROM search_results WHERE regexp_matches(url, '^https?://')), (VALUES ('/', true), ('/en', false), ('/en/products', true), ('/docs', false)) v(pre, allow) WHERE NOT contains(host, 'news')),
    m AS (SELECT u.seq, r.allow, row_number() OVER (PARTITION BY u.seq ORDER BY length(r.pre) DESC) AS n FROM u JOIN r ON r.host = u.host AND starts_with(u.p, r.pre))
    SELECT seq, url FROM u WHERE coalesce((SELECT allow FROM m WHERE m.seq = u.seq AND n = 1), true)"""
)
def robots_allowed(spark, t):
    """Addresses that the longest matching rule of their host lets through; a host without fresh rules allows all."""
    u = t("search_results").where(F.col("url").rlike("^https?://")).select("seq", "url")
    rules = spark.createDataFrame([("/", True), ("/en", False), ("/en/products", True), ("/docs", False)], "path_prefix string, allow boolean")
    host = U.authority(F.col("url")).alias("host")
    at = F.when(host.contains("news"), F.lit("2020-01-01")).otherwise(F.lit("2024-01-01 11:30:00")).cast("timestamp").alias("fetched_at")  # the one is out of date
    robots = u.select(host, at).distinct().join(F.broadcast(rules))
    return limits.allowed(u, robots, "2024-01-01 12:00:00")


# --- pages


def _html(t) -> DataFrame:
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    cell = lambda c: F.concat(F.lit("<td>"), esc(F.coalesce(c, F.lit(""))), F.lit("</td>"))
    row = lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, cell), ""), F.lit("</tr>"))
    tables = F.array_join(F.transform("tables", lambda x: F.concat(F.lit("<table>"), F.array_join(F.transform(x, row), ""), F.lit("</table>"))), "")
    page = F.concat(F.lit("<html><body><p>text</p>"), tables, F.lit("<a href='/docs/a.PDF'>s</a><a href='b.pdf'>t</a><a href='c.html'>u</a><img src='/i/x.png'><img alt='none'></body></html>"))
    return t("scraped_pages").where("tables is not null and page_id is not null").select("page_id", page.alias("html"))


_TRIM = r"'^[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$'"


@query(
    f"""WITH c AS (SELECT page_id, list_transform(tables, lambda tb: list_filter(list_transform(list_filter(tb, lambda r: len(r) > 0), lambda r: list_transform(r, lambda x: regexp_replace(coalesce(x, ''), {_TRIM}, '', 'g'))), lambda r: len(list_filter(r, lambda x: x <> '')) > 0)) AS ts FROM scraped_pages WHERE tables IS NOT NULL AND page_id IS NOT NULL)
    SELECT page_id, CAST(len(list_filter(ts, lambda tb: len(tb) >= 2)) AS INTEGER) AS tables, md5(array_to_string(list_transform(list_filter(ts, lambda tb: len(tb) >= 2), lambda tb: array_to_string(list_transform(tb, lambda r: array_to_string(r, '|')), ';')), '#')) AS cells,
      'https://h.example/docs/a.PDF https://h.example/p/b.pdf' AS pdfs, 'https://h.example/i/x.png' AS images FROM c"""
)
def html_parts(spark, t):
    """Tables, PDF links and images of pages written as HTML and parsed back."""
    p = _html(t).withColumn("p", html.parsed(F.col("html"), F.lit("https://h.example/p/q")))
    flat = F.array_join(F.transform("p.tables", lambda x: F.array_join(F.transform(x, lambda r: F.array_join(r, "|")), ";")), "#")
    return p.select("page_id", F.size("p.tables").alias("tables"), F.md5(flat).alias("cells"), F.array_join("p.pdf_links", " ").alias("pdfs"), F.array_join("p.images", " ").alias("images"))


@query("SELECT page_id, CAST(length(x) AS INTEGER) AS content_length, md5(x) AS text_md5 FROM (SELECT page_id, 'menu' || chr(10) || 'text ' || page_id || chr(10) || 'foot' AS x FROM scraped_pages WHERE page_id IS NOT NULL)")
def html_dynamic(spark, t):
    """Pages as a browser gives them, of which only scripts and styles are dropped."""
    raw = t("scraped_pages").where("page_id is not null").select("page_id", F.concat(F.lit("<nav>menu</nav><script>x()</script><style>p{}</style><p>text "), F.col("page_id").cast("string"), F.lit("</p><footer>foot</footer>")).alias("html"))
    p = raw.withColumn("p", html.parsed(F.col("html"), F.lit(""), dropped=("script", "style")))
    return p.select("page_id", "p.content_length", F.md5("p.text_content").alias("text_md5"))


@query("SELECT page_id, 'https://[2001:db8::1]/ok.pdf' AS pdfs FROM scraped_pages WHERE page_id IS NOT NULL")
def html_links(spark, t):
    """Links to local and private addresses are left out, also those of IPv6."""
    links = "<a href='http://[::1]/a.pdf'>a</a><a href='http://[fd00::1]/b.pdf'>b</a><a href='http://127.0.0.1/c.pdf'>c</a><a href='file:///etc/d.pdf'>d</a><a href='https://[2001:db8::1]/ok.pdf'>e</a>"
    raw = t("scraped_pages").where("page_id is not null").select("page_id", F.lit("https://h.example/").alias("url"), F.lit("<p>" + "x" * 101 + "</p>" + links).alias("html"))
    return html.pages(raw).select("page_id", F.array_join("pdf_links", " ").alias("pdfs"))


@query("WITH every AS (SELECT seq, url, brand, model FROM search_results UNION ALL SELECT 1000000000 + page_id, url, 'B', 'M' FROM scraped_pages WHERE url IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS n FROM every WHERE url IS NOT NULL) SELECT r.url, r.brand, r.model, p.page_id FROM r JOIN scraped_pages p ON p.url = r.url WHERE r.n = 1 AND length(p.text_content) > 100")
def scraping_phase(spark, t):
    """Fetched pages with the machine that their address was found for."""
    from .. import pipeline

    found = t("search_results").select("seq", "url", "brand", "model").unionByName(t("scraped_pages").where("url is not null").select((F.col("page_id") + 1_000_000_000).alias("seq"), "url", F.lit("B").alias("brand"), F.lit("M").alias("model")))
    return pipeline.scraped(found, t("scraped_pages").select("url", "page_id", "text_content")).select("url", "brand", "model", "page_id")


# --- facts and curves


@query(
    Q._facts_sql().replace("WITH texts", "WITH RECURSIVE texts").removesuffix(")")
    + "), "
    + Q._TABLES.removeprefix("WITH ").replace("facts AS", "tabled AS")
    + f", rated AS (SELECT page_id, parameter, value, unit, seq + 1000000000000 AS seq, {Q._confidence(0.8, False)} AS confidence FROM facts UNION ALL SELECT page_id, parameter, value, unit, seq, {Q._confidence(0.9, True)} AS confidence FROM tabled), "
    + Q._best_sql("rated")
)
def profile_specs(spark, t):
    """The profile of every page: the best of the facts in its tables and its text."""
    return specs.profile(t("scraped_pages").select("page_id", "url", F.col("text_content").alias("text"), "tables"), ["page_id"]).select("page_id", "parameter", "value", "unit", "confidence")


def _pages_of_curves(t, say) -> DataFrame:
    g = t("rimpull_points").groupBy("equipment_id", "source_url").agg(F.array_sort(F.collect_list(F.struct("id", say.alias("s")))).alias("x"))
    return g.select("equipment_id", "source_url", F.array_join(F.transform("x", lambda x: x["s"]), "").alias("text"))


_LISTED = "SELECT equipment_id, source_url, CAST(row_number() OVER (PARTITION BY equipment_id, source_url ORDER BY {rank}, id) - 1 AS INTEGER) AS seq, std AS gear, round({force}, 2) AS force_kn, '{unit}' AS original_unit FROM (SELECT *, {gear} AS std, count(*) OVER (PARTITION BY equipment_id, source_url) AS n FROM rimpull_points) WHERE n >= 2"


@query(_LISTED.format(rank=Q._RANK, gear=Q._GEAR, force="force_kn / 224.809", unit="lbf"))
def curve_tables_lbf(spark, t):
    """Curves in tables whose heading names pounds."""
    row = F.struct("id", F.array(curves.normalize_gear(F.col("gear")), F.col("force_kn").cast("string")).alias("r"))
    g = t("rimpull_points").groupBy("equipment_id", "source_url").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    pages = g.select("equipment_id", "source_url", F.array(F.concat(F.array(F.array(F.lit("Gear"), F.lit("Rimpull (lbf)"))), F.transform("rows", lambda x: x["r"]))).alias("tables"))
    return curves.from_tables(pages, url="source_url").select("equipment_id", "source_url", "seq", "gear", "force_kn", "original_unit")


@query(_LISTED.format(rank=Q._RANK, gear=Q._GEAR, force="force_kn / 101.972", unit="kgf"))
def curve_texts_named(spark, t):
    """Curves in sentences of the first family: a gear before the word."""
    return curves.from_text(_pages_of_curves(t, F.concat(curves.normalize_gear(F.col("gear")), F.lit(" gear rimpull: "), F.col("force_kn").cast("string"), F.lit(" kgf; "))), url="source_url").select("equipment_id", "source_url", "seq", "gear", "force_kn", "original_unit")


@query(
    """WITH m AS (SELECT id AS equipment_id, 100 + id % 400 AS f FROM equipment) SELECT equipment_id, g AS gear, CAST(f * k AS DOUBLE) AS force_kn, CAST(k - 1 AS INTEGER) AS seq FROM m, (VALUES ('1st', 1), ('2nd', 2), ('3rd', 3)) v(g, k)"""
)
def curve_texts_listed(spark, t):
    """Curves in sentences of the third family: a list of ordinals after the word."""
    f = F.lit(100) + F.col("id") % 400
    text = F.concat(F.lit("Rimpull by gear "), *[F.concat(F.lit(g), F.lit(": "), (f * k).cast("string"), F.lit(" kN, ")) for k, g in ((1, "1st"), (2, "2nd"), (3, "3rd"))])
    pages = t("equipment").select(F.col("id").alias("equipment_id"), F.lit("https://h.example/").alias("source_url"), text.alias("text"))
    return curves.from_text(pages, url="source_url").select("equipment_id", "gear", "force_kn", "seq")


# --- sinks, written and read back


@query("SELECT coalesce(brand, '') AS brand, coalesce(model, '') AS model, coalesce(title, '') AS title, coalesce(url, '') AS url, coalesce(snippet, '') AS snippet, coalesce(source_engine, '') AS source_engine, coalesce(query, '') AS query FROM search_results")
def search_csv(spark, t):
    """Search results written as CSV, with blanks, quotes and line ends in cells."""
    path = _folder(spark, "search-csv")
    report.write_search_csv(t("search_results"), path)
    back = report.csv_reader(spark).csv(path)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


@query(f"SELECT brand, model, parameter, count(*) AS n FROM {Q._SPECS} GROUP BY ALL")
def specs_csv(spark, t):
    """All specs and those of each brand written as CSV."""
    path = _folder(spark, "specs-csv")
    report.write_csv(Q._specs(t).select("brand", "model", "parameter", "value"), path)
    return report.csv_reader(spark).csv(f"{path}/by_brand").groupBy("brand", "model", "parameter").agg(F.count("*").alias("n"))


@query(f"SELECT 'brand ' || brand AS name, count(parameter) AS n FROM {Q._SPECS} GROUP BY brand UNION ALL SELECT 'parameter ' || parameter, count(*) FROM {Q._SPECS} GROUP BY parameter UNION ALL SELECT 'specs', count(*) FROM {Q._SPECS} UNION ALL SELECT 'models', count(DISTINCT model) FROM {Q._SPECS}")
def summary_json(spark, t):
    """The counts of summary.json."""
    s = json.loads(report.summary_json(Q._specs(t)))
    rows = [("specs", s["specs"]), ("models", s["models"]), *((f"brand {k}", v) for k, v in s["specs_per_brand"].items()), *((f"parameter {k}", v) for k, v in s["parameter_frequency"].items())]
    return spark.createDataFrame(rows, "name string, n bigint")


@query("SELECT page_id, md5(replace(replace('{\"v\":' || to_json(x) || '}', '</', '<\\/'), '<!--', '<\\!--')) AS j FROM (SELECT page_id, '</script><!-- ' || page_id || ' </b>' AS x FROM scraped_pages WHERE page_id IS NOT NULL)")
def json_safe(spark, t):
    """JSON that can stand in a script element."""
    x = F.concat(F.lit("</script><!-- "), F.col("page_id").cast("string"), F.lit(" </b>"))
    return t("scraped_pages").where("page_id is not null").select("page_id", F.md5(report.json_for_html(F.struct(x.alias("v")))).alias("j"))


@query("SELECT chunk_id, brand, substr(text, 1, 200) AS excerpt FROM document_chunks WHERE brand IS NOT NULL AND brand <> ''")
def vector_store(spark, t):
    """Chunks in a stored collection, read brand by brand."""
    path = _folder(spark, "vectors")
    vectors.store(t("document_chunks").where("brand <> ''"), path)
    return spark.read.parquet(path).select("chunk_id", F.col("brand").cast("string").alias("brand"), F.substring("text", 1, 200).alias("excerpt"))


@query(
    """WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0) SELECT CAST(vec_id AS VARCHAR) AS chunk_id, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 3) AS score, substr('vector ' || vec_id, 1, 200) AS excerpt FROM embeddings, q ORDER BY list_cosine_similarity(embedding::DOUBLE[], q.v) DESC, vec_id LIMIT 20"""
)
def search_shown(spark, t):
    """What a search prints: score and excerpt."""
    e = t("embeddings").select("vec_id", F.col("vec_id").cast("string").alias("chunk_id"), "embedding", F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("text"))
    q = e.where("vec_id = 0").select("embedding").first()[0]
    return vectors.shown(vectors.search(e, [float(x) for x in q], 20, key="vec_id"))


@query("SELECT 'equipment' AS table_name, count(*) AS n FROM equipment UNION ALL SELECT 'technical_specs', 2 * count(*) FROM technical_specs UNION ALL SELECT 'rimpull_points', count(*) FROM rimpull_points UNION ALL SELECT 'data_sources', 0")
def warehouse_tables(spark, t):
    """Tables created, replaced, appended to twice, backed up and counted in the copy."""
    w = warehouse.Warehouse(spark, _folder(spark, "warehouse"))
    w.create()
    w.replace("equipment", t("equipment").drop("brand"))
    w.replace("rimpull_points", t("rimpull_points"))
    for _ in range(2):
        w.append("technical_specs", t("technical_specs"))
    copy = _folder(spark, "copy")
    w.backup(copy)
    names = ("equipment", "technical_specs", "rimpull_points", "data_sources")
    return spark.createDataFrame([(n, spark.read.parquet(f"{copy}/{n}").count()) for n in names], "table_name string, n bigint")


@query("SELECT DISTINCT c.brand, c.model, e.id AS equipment_id FROM spec_candidates c JOIN equipment e ON e.brand = c.brand AND e.model = c.model")
def brand_lookup(spark, t):
    """Machines of the warehouse for the names in candidates."""
    e = t("equipment")
    return warehouse.machines_named(t("spec_candidates").select("brand", "model"), warehouse.brand_table(e), e).select("brand", "model", "equipment_id")


QUERIES = {k: v for k, v in Q.QUERIES.items() if v.__name__ in globals()}

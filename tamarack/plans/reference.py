"""Queries of the core operators over the test tables, each with the SQL that it is checked against."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls as U
from ..operators import chunks, consensus, curves, html, limits, qa, report, search, specs, vectors, warehouse
from ..session import shared_dir, table, tune
from ..streaming import ingest

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return f(spark, lambda name: table(spark, sf_dir, name))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return run

    return add


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(map(_lit, items)) + "]"


def _in(items) -> str:
    return "(" + ", ".join(map(_lit, items)) + ")"


def _within(domain: str, domains) -> str:
    return f"len(list_filter({_list(domains)}, lambda d: {domain} = d OR ends_with({domain}, '.' || d))) > 0"


_PARTS = "'^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)'"
_AUTH = f"lower(regexp_extract(url, {_PARTS}, 2))"
_DOMAIN = f"regexp_replace({_AUTH}, '^www\\.', '')"
_PATH = f"regexp_replace(lower(regexp_extract(url, {_PARTS}, 3)), ';[^/]*$', '')"
_CLASS = f"""CASE WHEN coalesce(url, '') = '' THEN 'generic' WHEN {_within(_DOMAIN, R.MANUFACTURERS)} THEN 'manufacturer'
 WHEN ends_with({_PATH}, '.pdf') THEN 'pdf_brochure' WHEN {_within(_DOMAIN, R.SPEC_DATABASES)} THEN 'spec_database' WHEN {_within(_DOMAIN, R.PUBLICATIONS)} THEN 'industry_publication'
 WHEN regexp_matches({_DOMAIN}, {_lit(R.DEALER)}, 'i') OR regexp_matches({_PATH}, {_lit(R.DEALER)}, 'i') THEN 'dealer' ELSE 'generic' END"""
_TRUST = "CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in R.TRUST.items()) + " END"


def _confidence(extraction: float, table: bool) -> str:
    return f"CAST(least(round(CAST({extraction} * 0.6 + ({_TRUST.format(c=_CLASS)}) * 0.4 + {0.05 if table else 0.0} AS DECIMAL(18, 9)), 3), 1.0) AS DOUBLE)"


# --- addresses

_HOSTILE = (
    "http://169.254.169.254/latest", "http://localhost/x", "http://10.1.2.3/", "http://172.20.0.1/a", "http://192.168.1.1", "ftp://files.example/a", "javascript:alert(1)", "", "https://metadata.google.internal/",
    "http://100.64.1.1/", "http://8.8.8.8/ok", "http://198.19.255.1/", "http://172.32.0.1/ok", "https://user@127.0.0.1:8080/", "file:///etc/passwd", "no scheme", "http://256.1.1.1/", "https://youtube.com/v", "https://m.facebook.com/x",
    "https://www.cat.com/a", "https://shop.komatsu.com/x.pdf", "https://www.lectura-specs.com/m", "https://mining.com/n", "https://used-machines.example/", "https://a.example/parts/1", "https://cat.com:443/x", "https://" + "a" * 2100,
    "http://[::1]/x", "http://[0:0::1]:8080/", "http://[fc00::1]/", "http://[fd12:3456::1]/a", "https://[fe80::1]/", "https://[FEBF::2]/", "http://[::ffff:127.0.0.1]/", "http://[::ffff:10.0.0.1]/", "http://[::ffff:7f00:1]/", "http://[2001:db8::5]/ok", "http://[::ffff:8.8.8.8]/ok", "http://[ff02::1]/ok",
)
_ALL_URLS = "SELECT url FROM data_sources UNION ALL SELECT url FROM search_results UNION ALL SELECT unnest(" + _list(_HOSTILE) + ") AS url"


def _urls(spark, t) -> DataFrame:
    hostile = spark.createDataFrame([(u,) for u in _HOSTILE], "url string")
    return t("data_sources").select("url").unionByName(t("search_results").select("url")).unionByName(hostile)


@query(f"SELECT url, {_CLASS} AS source_class, {_confidence(0.8, False)} AS text_confidence, {_confidence(0.9, True)} AS table_confidence FROM ({_ALL_URLS})")
def url_classify(spark, t):
    """Class of a source and confidence of its facts."""
    c = F.col("source_class")
    return _urls(spark, t).select("url", U.classify_source(F.col("url")).alias("source_class")).select("url", c, U.class_confidence(0.8, c).alias("text_confidence"), U.class_confidence(0.9, c, True).alias("table_confidence"))


_BARE = f"regexp_replace({_AUTH}, '^.*@', '')"
_HOST = f"CASE WHEN starts_with({_BARE}, '[') THEN regexp_extract({_BARE}, '^\\[([^\\]]*)\\]', 1) ELSE regexp_replace({_BARE}, ':\\d*$', '') END"
_OCTETS = r"'^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$'"


def _private_sql(host: str) -> str:
    import ipaddress

    n = f"list_reduce(list_transform(string_split({host}, '.'), lambda o: TRY_CAST(o AS BIGINT)), lambda a, b: a * 256 + b)"
    nets = [ipaddress.ip_network(x) for x in R.PRIVATE_V4]
    v4 = f"(regexp_matches({host}, {_OCTETS}) AND (" + " OR ".join(f"{n} BETWEEN {int(x.network_address)} AND {int(x.broadcast_address)}" for x in nets) + "))"
    # spelled out: the hostile addresses' IPv6 hosts that are private
    return f"({v4} OR {host} IN ('::1', '0:0::1', 'fc00::1', 'fd12:3456::1', 'fe80::1', 'febf::2', '::ffff:127.0.0.1', '::ffff:10.0.0.1', '::ffff:7f00:1'))"


def _safe_sql(url: str) -> str:
    host = "(" + _HOST.replace("(url,", f"({url},") + ")"
    return f"coalesce(length({url}) BETWEEN 1 AND {R.MAX_URL} AND lower(regexp_extract({url}, {_PARTS}, 1)) IN ('http', 'https') AND {host} <> '' AND {host} NOT IN {_in(R.BLOCKED_HOSTS)} AND NOT {_private_sql(host)}, false)"


@query(f"SELECT url, {_safe_sql('url')} AS safe, url IS NULL OR {_within(_AUTH, R.BLOCKED_DOMAINS)} AS blocked, coalesce(ends_with(lower(url), '.pdf'), false) AS pdf FROM ({_ALL_URLS})")
def url_safe(spark, t):
    """Safety, blocking and dispatch of addresses."""
    u = F.col("url")
    return _urls(spark, t).select("url", U.is_safe(u).alias("safe"), U.is_blocked(u).alias("blocked"), F.coalesce(U.is_pdf(u), F.lit(False)).alias("pdf"))


@query(
    f"""WITH a AS ({_ALL_URLS}), b AS (SELECT trim(url) AS tr FROM a WHERE url IS NOT NULL), c AS (SELECT tr, CASE WHEN regexp_matches(tr, '^https?://') THEN tr ELSE 'https://' || tr END AS full_url FROM b)
    SELECT tr AS url, CASE WHEN tr <> '' AND {_safe_sql('full_url')} THEN full_url ELSE '' END AS clean FROM c"""
)
def url_sanitize(spark, t):
    return _urls(spark, t).where("url is not null").select(F.trim("url").alias("url"), U.sanitize(F.col("url")).alias("clean"))


@query("SELECT seq, url, brand, model FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS n FROM search_results WHERE url IS NOT NULL) WHERE n = 1")
def url_first_wins(spark, t):
    return search.first_by_url(t("search_results")).select("seq", "url", "brand", "model")


@query(
    f"""SELECT seq, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS n FROM search_results
    WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM data_sources WHERE url IS NOT NULL) AND NOT coalesce({_within(_AUTH, R.BLOCKED_DOMAINS)}, true) AND {_safe_sql('url')}) WHERE n = 1"""
)
def search_accept(spark, t):
    """Results that are neither visited, blocked, unsafe nor repeated."""
    return search.accept(t("search_results"), t("data_sources")).select("seq", "url")


# --- inventory


@query(
    "SELECT e.id, t.template_no, "
    + "replace(replace(replace(replace(t.template, '{brand}', coalesce(e.brand, '')), '{model}', coalesce(e.model, '')), '{equipment_type}', coalesce(e.equipment_type, '')), '{year}', "
    + _lit(R.YEARS)
    + ") AS query FROM equipment e CROSS JOIN (SELECT unnest(range(20)) AS template_no, unnest("
    + _list((*R.QUERY_TEMPLATES, *R.EXPANDED_TEMPLATES))
    + ") AS template) t"
)
def query_templates(spark, t):
    return search.queries(t("equipment").select("id", "brand", "model", "equipment_type")).select("id", "template_no", "query")


@query("SELECT brand, category, equipment_type, CAST(grouping_id(brand, category, equipment_type) AS INTEGER) AS level, count(*) AS models FROM equipment GROUP BY GROUPING SETS ((brand, category), (category), (equipment_type), (brand), ())")
def inventory_groups(spark, t):
    return search.inventory(t("equipment"))


# --- facts from text and tables

_BLANKS = f"translate(text_content, {_lit(specs.BLANKS)}, '{' ' * len(specs.BLANKS)}')"


def _unit_sql(parameter: str) -> str:
    return "CASE u " + " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in R.unit_spellings(parameter).items()) + " ELSE u END"


def _facts_sql() -> str:
    parts = []
    for p in R.patterns():
        rx = _lit(p.regex)
        unit = f"unnest(regexp_extract_all(t, {rx}, 2, 'i'))" if p.has_unit else "unnest(list_transform(regexp_extract_all(t, " + rx + ", 0, 'i'), lambda x: ''))"
        inner = f"SELECT page_id, url, unnest(regexp_extract_all(t, {rx}, 1, 'i')) AS v, {unit} AS u, unnest(range(len(regexp_extract_all(t, {rx}, 0, 'i')))) AS i FROM texts"
        parts.append(f"SELECT page_id, url, '{p.parameter}' AS parameter, replace(v, ',', '') AS value, {_unit_sql(p.parameter)} AS unit, {p.seq} * 1000000 + i AS seq FROM ({inner})")
    return f"WITH texts AS (SELECT page_id, url, {_BLANKS} AS t FROM scraped_pages WHERE length(text_content) > 0), facts AS (" + " UNION ALL ".join(parts) + ")"


def _text_facts(t) -> DataFrame:
    return specs.from_text(t("scraped_pages").select("page_id", "url", F.col("text_content").alias("text")))


@query(_facts_sql() + f" SELECT page_id, parameter, value, unit, seq, {_confidence(0.8, False)} AS confidence FROM facts")
def text_specs(spark, t):
    """Facts in the whole texts of all pages."""
    return _text_facts(t).select("page_id", "parameter", "value", "unit", "seq", "confidence")


_NUM = r"'^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$'"
_RANGES = "(VALUES " + ", ".join(f"({_lit(p)}, {_lit(u)}, {float(lo)}, {float(hi)})" for p, us in R.RANGES.items() for u, (lo, hi) in us.items()) + ") AS r(parameter, unit, lo, hi)"


def _best_sql(source: str) -> str:
    """The best per page and parameter of facts(page_id, parameter, value, unit, seq, confidence) in ``source``."""
    num = f"CASE WHEN regexp_matches(value, {_NUM}) THEN TRY_CAST(trim(value) AS DOUBLE) END"
    kg = f"parameter IN {_in(R.KG_TO_TON)} AND unit = 'kg' AND v IS NOT NULL"
    mm = f"parameter IN {_in(R.MM_TO_M)} AND unit = 'mm' AND v IS NOT NULL"
    return f"""n AS (SELECT *, {num} AS v FROM {source}),
    m AS (SELECT page_id, parameter, seq, confidence, CASE WHEN {kg} THEN CAST(round(v / 1000, 2) AS VARCHAR) WHEN {mm} THEN CAST(round(v / 1000, 3) AS VARCHAR) ELSE value END AS value,
      CASE WHEN {kg} THEN 'ton' WHEN {mm} THEN 'm' ELSE unit END AS unit FROM n),
    k AS (SELECT m.page_id, m.parameter, m.value, m.unit, m.seq, CASE WHEN regexp_matches(m.value, {_NUM}) AND NOT (TRY_CAST(trim(m.value) AS DOUBLE) BETWEEN r.lo AND r.hi) THEN 0.3 ELSE m.confidence END AS confidence
      FROM m LEFT JOIN {_RANGES} ON r.parameter = m.parameter AND r.unit = m.unit),
    b AS (SELECT *, row_number() OVER (PARTITION BY page_id, parameter ORDER BY confidence DESC, seq) AS n FROM k)
    SELECT page_id, parameter, value, unit, CAST(confidence AS DOUBLE) AS confidence FROM b WHERE n = 1"""


@query(_facts_sql() + f", rated AS (SELECT page_id, parameter, value, unit, seq, {_confidence(0.8, False)} AS confidence FROM facts), " + _best_sql("rated"))
def text_specs_best(spark, t):
    return specs.best_per_parameter(_text_facts(t), ["page_id"]).select("page_id", "parameter", "value", "unit", "confidence")


def _cell(x: str) -> str:
    return f"trim(translate(coalesce({x}, ''), {_lit(specs.BLANKS)}, '{' ' * len(specs.BLANKS)}'))"


_LABELS = "CASE " + " ".join(f"WHEN contains(label, {_lit(k)}) THEN {_lit(v)}" for k, v in R.labels()) + " END"
_TABLES = f"""WITH tabs AS (SELECT page_id, url, unnest(tables) AS tb, unnest(range(len(tables))) AS ti FROM scraped_pages),
  heads AS (SELECT *, list_transform(tb[1], lambda c: lower({_cell('c')})) AS h FROM tabs WHERE len(tb) > 0),
  marked AS (SELECT page_id, url, ti, tb, regexp_matches(array_to_string(h, ' '), {_lit('|'.join(R.HEADER_WORDS))}) AS header,
    list_filter(range(len(h)), lambda i: list_contains({_list(R.UNIT_HEADERS)}, h[i + 1]))[1] AS ui FROM heads),
  cells AS (SELECT page_id, url, ti, header, CASE WHEN header THEN ui END AS ui, unnest(tb) AS r, unnest(range(len(tb))) AS ri FROM marked),
  kept AS (SELECT *, lower({_cell('r[1]')}) AS label, {_cell('r[2]')} AS raw, {_cell('r[3]')} AS third, {_cell('r[ui + 1]')} AS named FROM cells WHERE NOT (header AND ri = 0) AND len(r) >= 2),
  split AS (SELECT *, {_LABELS} AS parameter, regexp_extract(raw, '^([0-9,.]+)\\s*(.*)', 1) AS num, trim(regexp_extract(raw, '^([0-9,.]+)\\s*(.*)', 2)) AS extra FROM kept),
  facts AS (SELECT page_id, url, parameter, CASE WHEN num <> '' THEN replace(num, ',', '') ELSE raw END AS value,
    CASE WHEN len(r) >= 3 AND ui < len(r) THEN CASE WHEN named <> '' THEN named WHEN num <> '' THEN extra ELSE '' END WHEN len(r) >= 3 AND third <> '' AND length(third) <= 6 THEN third WHEN num <> '' THEN extra ELSE '' END AS unit,
    ti * 1000000 + ri AS seq FROM split WHERE parameter IS NOT NULL)"""


@query(_TABLES + f" SELECT page_id, parameter, value, unit, CAST(seq AS BIGINT) AS seq, {_confidence(0.9, True)} AS confidence FROM facts")
def table_specs(spark, t):
    """Facts in the tables of all pages."""
    return specs.from_tables(t("scraped_pages").select("page_id", "url", "tables")).select("page_id", "parameter", "value", "unit", "seq", "confidence")


@query(_TABLES + f", rated AS (SELECT page_id, parameter, value, unit, seq, {_confidence(0.9, True)} AS confidence FROM facts), " + _best_sql("rated"))
def table_specs_best(spark, t):
    return specs.best_per_parameter(specs.from_tables(t("scraped_pages").select("page_id", "url", "tables")), ["page_id"]).select("page_id", "parameter", "value", "unit", "confidence")


@query(
    f"""SELECT s.id, s.parameter, CASE WHEN regexp_matches(s.value, {_NUM}) AND NOT (TRY_CAST(trim(s.value) AS DOUBLE) BETWEEN r.lo AND r.hi) THEN 0.3 ELSE s.confidence END AS confidence
    FROM technical_specs s LEFT JOIN {_RANGES} ON r.parameter = s.parameter AND r.unit = s.unit"""
)
def spec_range_check(spark, t):
    return specs.check_range(t("technical_specs").select("id", "parameter", "value", "unit", "confidence")).select("id", "parameter", "confidence")


@query(
    f"""WITH k AS (SELECT id, parameter, CASE WHEN regexp_matches(value, {_NUM}) THEN TRY_CAST(trim(value) AS DOUBLE) END AS v, value, unit FROM technical_specs)
    SELECT id, CASE WHEN v IS NOT NULL AND parameter IN {_in(R.KG_TO_TON)} AND unit = 'kg' THEN CAST(round(v / 1000, 2) AS VARCHAR) WHEN v IS NOT NULL AND parameter IN {_in(R.MM_TO_M)} AND unit = 'mm' THEN CAST(round(v / 1000, 3) AS VARCHAR) ELSE value END AS value,
      CASE WHEN v IS NOT NULL AND parameter IN {_in(R.KG_TO_TON)} AND unit = 'kg' THEN 'ton' WHEN v IS NOT NULL AND parameter IN {_in(R.MM_TO_M)} AND unit = 'mm' THEN 'm' ELSE unit END AS unit FROM k"""
)
def spec_normalize(spark, t):
    return specs.normalize(t("technical_specs").select("id", "parameter", "value", "unit")).select("id", "value", "unit")


# --- checks

_PLAIN = "replace(trim(value), ',', '')"
_QA = f"""q AS (SELECT s.*, r.lo, r.hi, CASE WHEN regexp_matches({_PLAIN}, {_NUM}) THEN TRY_CAST(trim({_PLAIN}) AS DOUBLE) END AS num, s.parameter IN {_in(R.TEXT_PARAMETERS)} AS textual
    FROM technical_specs s LEFT JOIN {_RANGES} ON r.parameter = s.parameter AND r.unit = s.unit),
  c AS (SELECT *, CASE WHEN coalesce(trim(value), '') = '' THEN 'empty' WHEN regexp_matches(trim(value), {_lit(R.PLACEHOLDER)}) THEN 'placeholder' WHEN NOT textual AND num IS NULL THEN 'not_numeric'
    WHEN coalesce(num < lo * 0.5 OR num > hi * 2, false) THEN 'out_of_range' ELSE '' END AS issue FROM q),
  d AS (SELECT *, issue = '' AS passed, NOT textual AND coalesce(unit, '') = '' AND issue NOT IN ('empty', 'placeholder', 'not_numeric') AS unit_missing FROM c)"""


@query(f"WITH {_QA} SELECT id, issue, unit_missing, passed FROM d")
def qa_single(spark, t):
    return qa.check(t("technical_specs")).select("id", "issue", "unit_missing", "passed")


_CORE = (
    "CASE WHEN regexp_matches(lower(coalesce(kind, '')), 'excav|pala|shovel') THEN " + _list(R.CORE["excavator"]) + " WHEN regexp_matches(lower(coalesce(kind, '')), 'cami|truck|haul') THEN " + _list(R.CORE["truck"]) + " ELSE " + _list(R.CORE["generic"]) + " END"
)


@query(
    f"""WITH {_QA}, g AS (SELECT equipment_id, count(*) AS total_input, count(*) FILTER (WHERE passed) AS total_valid, count(*) FILTER (WHERE NOT passed) AS total_rejected, count(*) FILTER (WHERE passed AND unit_missing) AS warnings,
      count(*) FILTER (WHERE issue = 'placeholder') AS placeholders, list(DISTINCT parameter) FILTER (WHERE passed) AS found FROM d GROUP BY equipment_id),
    h AS (SELECT g.*, e.equipment_type AS kind FROM g LEFT JOIN equipment e ON e.id = g.equipment_id), i AS (SELECT *, {_CORE} AS core FROM h)
    SELECT equipment_id, total_input, total_valid, total_rejected, round(CAST(total_rejected * 100.0 / total_input AS DECIMAL(18, 9)), 1)::DOUBLE AS rejection_rate,
      round(CAST(len(list_intersect(core, coalesce(found, []))) * 1.0 / len(core) AS DECIMAL(18, 9)), 2)::DOUBLE AS completeness,
      array_to_string(list_sort(list_filter(core, lambda x: NOT list_contains(coalesce(found, []), x))), ',') AS missing_core, warnings, placeholders FROM i"""
)
def qa_report(spark, t):
    kinds = t("equipment").select(F.col("id").alias("equipment_id"), "equipment_type")
    r = qa.report(t("technical_specs").join(kinds, "equipment_id", "left"), ["equipment_id"], "equipment_type")
    return r.select("equipment_id", "total_input", "total_valid", "total_rejected", "rejection_rate", "completeness", F.array_join("missing_core", ",").alias("missing_core"), "warnings", F.col("placeholder").alias("placeholders"))


@query(
    f"""WITH {_QA}, l AS (SELECT *, row_number() OVER (PARTITION BY equipment_id, parameter ORDER BY id DESC) AS n FROM d WHERE passed AND parameter IN ('peso_vacio', 'peso_operativo'))
    SELECT a.equipment_id, a.num AS lower_value, b.num AS upper_value FROM l a JOIN l b ON a.equipment_id = b.equipment_id AND a.parameter = 'peso_vacio' AND b.parameter = 'peso_operativo' AND a.n = 1 AND b.n = 1 AND a.unit = b.unit AND a.num >= b.num"""
)
def qa_constraints(spark, t):
    return qa.constraints(qa.check(t("technical_specs")), ["equipment_id"], "id").select("equipment_id", "lower_value", "upper_value")


# --- consensus

_TOL = "CASE parameter " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in R.TOLERANCES.items()) + f" ELSE {R.TOLERANCE} END"


@query(
    f"""WITH RECURSIVE base AS (SELECT run_id, equipment_id, parameter, candidate_id AS seq, value, unit, coalesce(confidence, 0.0) AS conf, source_url,
        CASE WHEN regexp_matches(replace(value, ',', ''), {_NUM}) THEN TRY_CAST(trim(replace(value, ',', '')) AS DOUBLE) END AS v, {_TOL} AS tol FROM spec_candidates),
      nums AS (SELECT *, row_number() OVER (PARTITION BY run_id, equipment_id, parameter ORDER BY v, source_url NULLS FIRST, seq) AS rn FROM base WHERE v IS NOT NULL),
      walk AS (SELECT run_id, equipment_id, parameter, rn, v AS total, 1 AS cnt, 1 AS cl FROM nums WHERE rn = 1
        UNION ALL SELECT n.run_id, n.equipment_id, n.parameter, n.rn, CASE WHEN w.total / w.cnt > 0 AND abs(n.v - w.total / w.cnt) / (w.total / w.cnt) * 100 <= n.tol THEN w.total + n.v ELSE n.v END,
          CASE WHEN w.total / w.cnt > 0 AND abs(n.v - w.total / w.cnt) / (w.total / w.cnt) * 100 <= n.tol THEN w.cnt + 1 ELSE 1 END,
          CASE WHEN w.total / w.cnt > 0 AND abs(n.v - w.total / w.cnt) / (w.total / w.cnt) * 100 <= n.tol THEN w.cl ELSE w.cl + 1 END
        FROM walk w JOIN nums n ON n.run_id = w.run_id AND n.equipment_id = w.equipment_id AND n.parameter = w.parameter AND n.rn = w.rn + 1),
      sizes AS (SELECT run_id, equipment_id, parameter, cl, count(*) AS size FROM walk GROUP BY ALL),
      main AS (SELECT run_id, equipment_id, parameter, arg_min(cl, -size * 100000 + cl) AS cl, max(size) AS agree, sum(size) AS numeric_n FROM sizes GROUP BY ALL),
      inside AS (SELECT n.*, m.agree, m.numeric_n FROM nums n JOIN walk w USING (run_id, equipment_id, parameter, rn) JOIN main m ON m.run_id = n.run_id AND m.equipment_id = n.equipment_id AND m.parameter = n.parameter AND m.cl = w.cl),
      best AS (SELECT *, row_number() OVER (PARTITION BY run_id, equipment_id, parameter ORDER BY conf DESC, rn) AS b FROM inside),
      texts AS (SELECT *, row_number() OVER (PARTITION BY run_id, equipment_id, parameter ORDER BY conf DESC, source_url NULLS FIRST, seq) AS b FROM base WHERE v IS NULL),
      labelled AS (SELECT n.run_id, n.equipment_id, n.parameter, n.rn, n.v, n.source_url, w.cl = m.cl AS main FROM nums n JOIN walk w USING (run_id, equipment_id, parameter, rn) JOIN main m ON m.run_id = n.run_id AND m.equipment_id = n.equipment_id AND m.parameter = n.parameter),
      lists AS (SELECT run_id, equipment_id, parameter, list(source_url ORDER BY rn) FILTER (WHERE main) AS srcs, string_agg(printf('%.1f', v), ', ' ORDER BY rn) FILTER (WHERE NOT main) AS outs FROM labelled GROUP BY ALL),
      said AS (SELECT run_id, equipment_id, parameter, list(source_url ORDER BY source_url NULLS FIRST, seq) AS srcs FROM base WHERE v IS NULL GROUP BY ALL),
      g AS (SELECT run_id, equipment_id, parameter, count(*) AS n, count(v) AS nn, count(DISTINCT lower(value)) AS words, count(*) FILTER (WHERE value IS NULL) AS nulls FROM base GROUP BY ALL)
    SELECT g.run_id, g.equipment_id, g.parameter, CASE WHEN nn > 0 THEN x.value ELSE y.value END AS best_value, CASE WHEN nn > 0 THEN x.unit ELSE y.unit END AS best_unit,
      CASE WHEN g.n = 1 OR nn = 0 THEN coalesce(x.conf, y.conf) ELSE CAST(round(CAST(least(x.conf + 0.1 * x.agree / g.n, CASE WHEN x.agree < x.numeric_n THEN 0.85 ELSE 1.0 END) AS DECIMAL(18, 9)), 3) AS DOUBLE) END AS final_confidence,
      CAST(g.n AS INTEGER) AS source_count, CASE WHEN g.n = 1 THEN true WHEN nn = 0 THEN words + least(nulls, 1) = 1 ELSE x.agree = x.numeric_n END AS consensus,
      array_to_string(list_transform(CASE WHEN nn > 0 THEN l.srcs ELSE z.srcs END, lambda u: coalesce(u, '-')), ' ') AS sources,
      CASE WHEN nn > 0 AND x.agree < x.numeric_n THEN 'Conflict: ' || x.agree || '/' || g.n || ' sources agree on ~' || printf('%.1f', x.v) || '. Outliers: ' || l.outs ELSE '' END AS conflict_detail
    FROM g LEFT JOIN lists l ON l.run_id = g.run_id AND l.equipment_id = g.equipment_id AND l.parameter = g.parameter LEFT JOIN said z ON z.run_id = g.run_id AND z.equipment_id = g.equipment_id AND z.parameter = g.parameter
      LEFT JOIN best x ON x.run_id = g.run_id AND x.equipment_id = g.equipment_id AND x.parameter = g.parameter AND x.b = 1
      LEFT JOIN texts y ON y.run_id = g.run_id AND y.equipment_id = g.equipment_id AND y.parameter = g.parameter AND y.b = 1"""
)
def consensus_specs(spark, t):
    """Consensus over all candidates of all runs."""
    c = consensus.consensus(t("spec_candidates").withColumn("seq", F.col("candidate_id")), ["run_id", "equipment_id"])
    sources = F.array_join(F.transform("sources", lambda u: F.coalesce(u, F.lit("-"))), " ").alias("sources")
    return c.select("run_id", "equipment_id", "parameter", "best_value", "best_unit", "final_confidence", "source_count", "consensus", sources, "conflict_detail")


# --- curves

_GEAR_KEY = "regexp_replace(lower(trim(gear)), '\\.+$', '')"
_GEAR = "CASE " + " ".join(f"WHEN {_GEAR_KEY} IN {_in(w)} THEN '{g}'" for g, w in R.GEARS.items()) + " ELSE trim(gear) END"
_RANK = "CASE std " + " ".join(f"WHEN '{g}' THEN {r}" for g, r in R.GEAR_RANK.items()) + " ELSE 99 END"


@query(
    f"""WITH s AS (SELECT *, {_GEAR} AS std FROM rimpull_points) SELECT id, std AS gear, {_RANK} AS gear_rank,
    round(CASE WHEN lower(trim(original_unit)) IN ('lbf', 'lb') THEN force_kn / {R.LBF_PER_KN} WHEN lower(trim(original_unit)) = 'kgf' THEN force_kn / {R.KGF_PER_KN} ELSE force_kn END, 2) AS kn FROM s"""
)
def curve_normalize(spark, t):
    g = curves.normalize_gear(F.col("gear"))
    return t("rimpull_points").select("id", g.alias("gear"), curves.gear_rank(g).alias("gear_rank"), F.round(curves.to_kn(F.col("force_kn"), F.col("original_unit")), 2).alias("kn"))


_CURVE_POINTS = f"""s AS (SELECT *, {_GEAR} AS std, CASE WHEN force_kn = 0 THEN 'zero' WHEN force_kn IS NULL OR NOT force_kn BETWEEN 50 AND 2000 THEN 'force' WHEN speed_kmh IS NOT NULL AND NOT (speed_kmh > 0 AND speed_kmh <= 80) THEN 'speed' ELSE '' END AS issue FROM rimpull_points),
  f AS (SELECT equipment_id, source_url, force_kn, lag(force_kn) OVER (PARTITION BY equipment_id, source_url ORDER BY {_RANK}, id) AS before FROM s WHERE issue = '' AND std <> 'Reverse'),
  rises AS (SELECT equipment_id, source_url, count(*) FILTER (WHERE force_kn > before) AS rises FROM f GROUP BY ALL)"""


@query(
    f"""WITH {_CURVE_POINTS} SELECT c.equipment_id, c.source_url, c.total_input, c.total_valid, c.bad_zero, c.bad_force, c.bad_speed, c.total_valid >= 2 AS passed, coalesce(r.rises, 0) AS rises
    FROM (SELECT equipment_id, source_url, count(*) AS total_input, count(*) FILTER (WHERE issue = '') AS total_valid, count(*) FILTER (WHERE issue = 'zero') AS bad_zero, count(*) FILTER (WHERE issue = 'force') AS bad_force,
      count(*) FILTER (WHERE issue = 'speed') AS bad_speed FROM s GROUP BY ALL) c LEFT JOIN rises r ON r.equipment_id IS NOT DISTINCT FROM c.equipment_id AND r.source_url IS NOT DISTINCT FROM c.source_url"""
)
def curve_qa(spark, t):
    """Checks of every curve: the points of a machine from one source."""
    p = t("rimpull_points").withColumn("seq", F.col("id")).withColumn("gear", curves.normalize_gear(F.col("gear")))
    return curves.check(p, ["equipment_id", "source_url"])[1]


@query(
    f"""WITH RECURSIVE s AS (SELECT equipment_id, {_GEAR} AS std, force_kn AS v, coalesce(source_url, '') AS url, original_unit, coalesce(confidence, 0.0) AS conf, speed_kmh FROM rimpull_points),
      many AS (SELECT equipment_id FROM s GROUP BY 1 HAVING count(DISTINCT url) > 1), a AS (SELECT * FROM s WHERE equipment_id IN (SELECT equipment_id FROM many)),
      nums AS (SELECT *, row_number() OVER (PARTITION BY equipment_id, std ORDER BY v, url, original_unit NULLS FIRST, conf, speed_kmh NULLS FIRST) AS rn FROM a),
      walk AS (SELECT equipment_id, std, rn, v AS total, 1 AS cnt, 1 AS cl FROM nums WHERE rn = 1
        UNION ALL SELECT n.equipment_id, n.std, n.rn, CASE WHEN w.total / w.cnt > 0 AND abs(n.v - w.total / w.cnt) / (w.total / w.cnt) * 100 <= 10 THEN w.total + n.v ELSE n.v END,
          CASE WHEN w.total / w.cnt > 0 AND abs(n.v - w.total / w.cnt) / (w.total / w.cnt) * 100 <= 10 THEN w.cnt + 1 ELSE 1 END, CASE WHEN w.total / w.cnt > 0 AND abs(n.v - w.total / w.cnt) / (w.total / w.cnt) * 100 <= 10 THEN w.cl ELSE w.cl + 1 END
        FROM walk w JOIN nums n ON n.equipment_id = w.equipment_id AND n.std = w.std AND n.rn = w.rn + 1),
      sizes AS (SELECT equipment_id, std, cl, count(*) AS size FROM walk GROUP BY ALL),
      main AS (SELECT equipment_id, std, arg_min(cl, -size * 100000 + cl) AS cl, max(size) AS agree, sum(size) AS n, count(*) AS groups FROM sizes GROUP BY ALL),
      inside AS (SELECT n.*, m.agree, m.n, m.groups FROM nums n JOIN walk w USING (equipment_id, std, rn) JOIN main m ON m.equipment_id = n.equipment_id AND m.std = n.std AND m.cl = w.cl),
      best AS (SELECT *, row_number() OVER (PARTITION BY equipment_id, std ORDER BY conf DESC, rn) AS b FROM inside), speeds AS (SELECT equipment_id, std, avg(speed_kmh) AS mean FROM inside GROUP BY ALL),
      made AS (SELECT b.equipment_id, b.std AS gear, CASE WHEN b.n = 1 THEN b.speed_kmh ELSE CAST(round(CAST(s.mean AS DECIMAL(18, 9)), 1) AS DOUBLE) END AS speed_kmh, round(b.v, 2) AS force_kn,
        CASE WHEN b.n = 1 THEN b.conf ELSE CAST(round(CAST(least(b.conf + 0.1 * b.agree / b.n, CASE WHEN b.groups > 1 THEN 0.85 ELSE 1.0 END) AS DECIMAL(18, 9)), 3) AS DOUBLE) END AS confidence, b.url AS source_url
        FROM best b JOIN speeds s ON s.equipment_id = b.equipment_id AND s.std = b.std WHERE b.b = 1),
      ones AS (SELECT equipment_id, std AS gear, speed_kmh, v AS force_kn, conf AS confidence, url AS source_url FROM s WHERE equipment_id NOT IN (SELECT equipment_id FROM many)),
      every AS (SELECT * FROM made UNION ALL SELECT * FROM ones)
    SELECT * FROM every WHERE equipment_id IN (SELECT equipment_id FROM every GROUP BY 1 HAVING count(*) >= 2)"""
)
def curve_consensus(spark, t):
    """One curve per machine from all its sources."""
    p = t("rimpull_points").withColumn("curve", F.col("source_url"))
    return curves.consensus(p, ["equipment_id"], "curve").select("equipment_id", "gear", "speed_kmh", "force_kn", "confidence", "source_url")


_CURVES = f"""WITH s AS (SELECT *, {_GEAR} AS std, count(*) OVER (PARTITION BY equipment_id, source_url) AS n FROM rimpull_points)
  SELECT equipment_id, source_url, CAST(row_number() OVER (PARTITION BY equipment_id, source_url ORDER BY {_RANK}, id) - 1 AS INTEGER) AS seq, std AS gear, {{speed}} AS speed_kmh, round(force_kn, 2) AS force_kn FROM s WHERE n >= 2"""


@query(_CURVES.format(speed="speed_kmh"))
def curve_tables(spark, t):
    """Every curve written as a page's table and read back."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.struct("id", F.array(curves.normalize_gear(F.col("gear")), cell("speed_kmh"), cell("force_kn")).alias("r"))
    g = t("rimpull_points").groupBy("equipment_id", "source_url").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    head = F.array(F.lit("Gear"), F.lit("Speed (km/h)"), F.lit("Rimpull (kN)"))
    pages = g.select("equipment_id", "source_url", F.array(F.concat(F.array(head), F.transform("rows", lambda x: x["r"]))).alias("tables"))
    return curves.from_tables(pages, url="source_url").select("equipment_id", "source_url", "seq", "gear", "speed_kmh", "force_kn")


@query(_CURVES.format(speed="CAST(NULL AS DOUBLE)"))
def curve_texts(spark, t):
    """Every curve written as a sentence and read back."""
    say = F.concat(F.lit("Rimpull ("), curves.normalize_gear(F.col("gear")), F.lit(" gear): "), F.col("force_kn").cast("string"), F.lit(" kN; "))
    g = t("rimpull_points").groupBy("equipment_id", "source_url").agg(F.array_sort(F.collect_list(F.struct("id", say.alias("s")))).alias("x"))
    pages = g.select("equipment_id", "source_url", F.array_join(F.transform("x", lambda x: x["s"]), "").alias("text"))
    return curves.from_text(pages, url="source_url").select("equipment_id", "source_url", "seq", "gear", "speed_kmh", "force_kn")


# --- warehouse

_SPECS = """(SELECT b.name AS brand, e.model, e.category, e.equipment_type, s.id, s.parameter, s.value, s.unit, s.confidence, s.source_url, s.extracted_at FROM technical_specs s JOIN equipment e ON e.id = s.equipment_id
  JOIN (SELECT brand_id AS id, min(brand) AS name FROM equipment GROUP BY 1) b ON b.id = e.brand_id)"""


def _specs(t) -> DataFrame:
    e, s = t("equipment"), t("technical_specs")
    return s.join(e.select(F.col("id").alias("equipment_id"), "brand", "model", "category", "equipment_type"), "equipment_id")


@query(f"SELECT brand, model, category, equipment_type, parameter, value, unit, confidence, source_url, epoch_us(extracted_at) AS extracted_us FROM {_SPECS}")
def specs_join(spark, t):
    e = t("equipment")
    return warehouse.specs_frame(warehouse.brand_table(e), e, t("technical_specs")).withColumn("extracted_us", F.unix_micros("extracted_at")).drop("extracted_at")


@query("SELECT e.brand, e.model, p.gear, p.speed_kmh, p.force_kn, p.confidence FROM rimpull_points p JOIN equipment e ON e.id = p.equipment_id")
def curves_join(spark, t):
    e = t("equipment")
    return warehouse.curves_frame(warehouse.brand_table(e), e, t("rimpull_points"))


@query("SELECT DISTINCT s.url FROM data_sources s JOIN equipment e ON e.id = s.equipment_id WHERE e.brand = 'Kalvek Mining Equipment'")
def visited_urls(spark, t):
    e = t("equipment")
    return warehouse.visited_urls(warehouse.brand_table(e), e, t("data_sources"), "Kalvek Mining Equipment")


@query(
    """SELECT b.brand, b.models, coalesce(s.specs, 0) AS specs, coalesce(u.sources, 0) AS sources, epoch_us(s.last) AS last_us FROM (SELECT brand_id, min(brand) AS brand, count(*) AS models FROM equipment GROUP BY 1) b
    LEFT JOIN (SELECT e.brand_id, count(*) AS specs, max(extracted_at) AS last FROM technical_specs t JOIN equipment e ON e.id = t.equipment_id GROUP BY 1) s USING (brand_id)
    LEFT JOIN (SELECT e.brand_id, count(*) AS sources FROM data_sources t JOIN equipment e ON e.id = t.equipment_id GROUP BY 1) u USING (brand_id)"""
)
def brand_status(spark, t):
    e = t("equipment")
    s = warehouse.brand_status(warehouse.brand_table(e), e, t("technical_specs"), t("data_sources"))
    return s.withColumn("last_us", F.unix_micros("last_extraction")).drop("last_extraction")


@query("SELECT e.id, e.brand, e.model, count(s.id) AS specs FROM equipment e LEFT JOIN technical_specs s ON s.equipment_id = e.id GROUP BY ALL")
def brand_detail_zero(spark, t):
    return warehouse.model_counts(t("equipment"), t("technical_specs"))


@query(
    """WITH gone AS (SELECT id FROM equipment WHERE brand_id = 1) SELECT 'technical_specs' AS table_name, count(*) AS removed FROM technical_specs WHERE equipment_id IN (SELECT id FROM gone)
    UNION ALL SELECT 'data_sources', count(*) FROM data_sources WHERE equipment_id IN (SELECT id FROM gone) UNION ALL SELECT 'rimpull_points', count(*) FROM rimpull_points WHERE equipment_id IN (SELECT id FROM gone)
    UNION ALL SELECT 'equipment', count(*) FROM gone"""
)
def clear_brand(spark, t):
    return warehouse.clear_brand(1, t("equipment"), technical_specs=t("technical_specs"), data_sources=t("data_sources"), rimpull_points=t("rimpull_points"))[1]


@query("SELECT s.id, s.equipment_id, s.parameter FROM technical_specs s WHERE s.equipment_id NOT IN (SELECT id FROM equipment WHERE brand_id = 1)")
def clear_brand_rest(spark, t):
    return warehouse.clear_brand(1, t("equipment"), technical_specs=t("technical_specs"))[0]["technical_specs"].select("id", "equipment_id", "parameter")


@query("SELECT DISTINCT c.brand, c.model FROM spec_candidates c WHERE NOT EXISTS (SELECT 1 FROM equipment e WHERE e.brand = c.brand AND e.model = c.model)")
def insert_absent(spark, t):
    """Machines of the candidates that the warehouse doesn't have yet."""
    return warehouse.absent(t("spec_candidates").select("brand", "model"), t("equipment"), ["brand", "model"])


@query(
    """WITH new AS (SELECT run_id, equipment_id, parameter, max(candidate_id) AS candidate_id FROM spec_candidates GROUP BY ALL), old AS (SELECT run_id, equipment_id, parameter, CAST(-1 AS BIGINT) AS candidate_id FROM validation_results)
    SELECT * FROM new UNION ALL SELECT o.* FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.run_id = o.run_id AND n.equipment_id = o.equipment_id AND n.parameter = o.parameter)"""
)
def upsert(spark, t):
    k = ["run_id", "equipment_id", "parameter"]
    new = t("spec_candidates").groupBy(*k).agg(F.max("candidate_id").alias("candidate_id"))
    return warehouse.upsert(new, t("validation_results").select(*k, F.lit(-1).cast("bigint").alias("candidate_id")), k)


# --- report


@query(f"SELECT count(DISTINCT brand) AS brands, count(DISTINCT model) AS models, count(*) AS specs, round(avg(confidence), 2) AS avg_confidence FROM {_SPECS}")
def report_summary(spark, t):
    return report.summary(_specs(t))


@query(f"SELECT brand, count(parameter) AS specs FROM {_SPECS} GROUP BY 1")
def spec_counts(spark, t):
    return report.specs_per_brand(_specs(t))


@query(f"SELECT parameter, count(*) AS specs FROM {_SPECS} GROUP BY 1")
def param_freq(spark, t):
    return report.parameter_frequency(_specs(t))


@query("SELECT brand, model, equipment_type, " + ", ".join(f"arg_min(value, id) FILTER (WHERE parameter = '{p}' AND value IS NOT NULL) AS {p}" for p in R.RANGES) + f" FROM {_SPECS} GROUP BY ALL")
def pivot_specs(spark, t):
    return report.pivot(_specs(t), list(R.RANGES))


@query(
    f"""SELECT * FROM (SELECT model, arg_min(value, id) FILTER (WHERE parameter = 'peso_operativo') AS peso_operativo, arg_min(value, id) FILTER (WHERE parameter = 'potencia_motor') AS potencia_motor
    FROM {_SPECS} WHERE value IS NOT NULL GROUP BY 1) WHERE peso_operativo IS NOT NULL AND potencia_motor IS NOT NULL"""
)
def weight_power_pairs(spark, t):
    return report.paired(_specs(t), "peso_operativo", "potencia_motor")


@query(f"SELECT m.model, p.parameter, f.confidence FROM (SELECT DISTINCT model FROM {_SPECS}) m CROSS JOIN (SELECT DISTINCT parameter FROM {_SPECS}) p LEFT JOIN (SELECT model, parameter, arg_min_null(confidence, id) AS confidence FROM {_SPECS} GROUP BY ALL) f ON f.model = m.model AND f.parameter = p.parameter")
def conf_heatmap(spark, t):
    return report.heatmap(_specs(t))


@query("SELECT id, CASE WHEN confidence >= 0.7 THEN 'high' WHEN confidence >= 0.5 THEN 'mid' ELSE 'low' END AS band FROM technical_specs")
def conf_band(spark, t):
    return t("technical_specs").select("id", report.confidence_band(F.col("confidence")).alias("band"))


@query(f"SELECT id, brand, model, parameter, confidence FROM {_SPECS} WHERE brand = 'Kalvek Mining Equipment' AND parameter = 'torque' AND confidence >= 0.8 AND contains(lower(model), 'r')")
def report_filter(spark, t):
    return report.sorted_by(report.filtered(_specs(t), "Kalvek Mining Equipment", "torque", 0.8, "R"), "confidence", True).select("id", "brand", "model", "parameter", "confidence")


@query(f"SELECT brand, array_to_string(list_sort(list(DISTINCT parameter)), ',') AS parameters FROM {_SPECS} GROUP BY 1")
def distinct_lists(spark, t):
    return _specs(t).groupBy("brand").agg(F.array_join(F.array_sort(F.collect_set("parameter")), ",").alias("parameters"))


@query(
    f"""WITH s AS (SELECT e.brand, e.model, p.gear, p.speed_kmh, p.force_kn FROM rimpull_points p JOIN equipment e ON e.id = p.equipment_id WHERE p.speed_kmh IS NOT NULL)
    SELECT brand, model, count(*) AS points, round(sum(force_kn * rn), 3) AS weighted FROM (SELECT *, row_number() OVER (PARTITION BY brand, model ORDER BY speed_kmh, gear, force_kn) AS rn FROM s) GROUP BY ALL"""
)
def curve_series(spark, t):
    e = t("equipment")
    s = report.series(warehouse.curves_frame(warehouse.brand_table(e), e, t("rimpull_points")), by_speed=True)
    return s.groupBy("brand", "model").agg(F.count("*").alias("points"), F.round(F.sum(F.col("force_kn") * F.col("place")), 3).alias("weighted"))


@query("SELECT DISTINCT brand, substr(regexp_replace(replace(brand, ' ', '_'), '[^A-Za-z0-9_-]', '', 'g'), 1, 30) AS file_name FROM equipment")
def brand_files(spark, t):
    return t("equipment").select("brand").distinct().withColumn("file_name", report.file_name(F.col("brand")))


# --- chunks and vectors

_WHITE = r"'[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"


@query(
    f"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, {_WHITE}), lambda x: x <> '') AS words FROM documents), s AS (SELECT doc_id, words, unnest(range(0, len(words), 462)) AS start FROM w WHERE len(words) > 0)
    SELECT doc_id, CAST(start // 462 AS INTEGER) AS chunk_no, substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) || '_' || CAST(start // 462 AS VARCHAR) AS chunk_id, md5(array_to_string(words[start + 1 : start + 512], ' ')) AS chunk_md5, CAST(least(512, len(words) - start) AS INTEGER) AS words FROM s"""
)
def chunk_documents(spark, t):
    c = chunks.chunk_words(t("documents").select("doc_id", "text"), url="doc_id")
    return c.select("doc_id", "chunk_no", "chunk_id", F.md5("chunk").alias("chunk_md5"), "words")


@query(
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), s AS (SELECT q.vec_id AS query, x.vec_id AS near, round(list_cosine_similarity(q.v, x.v), 6) AS similarity FROM e q JOIN e x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
    SELECT query, near, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, near) AS n FROM s) WHERE n <= 10"""
)
def knn_cosine(spark, t):
    """The ten nearest of every hundredth vector among all."""
    e = t("embeddings").select("vec_id", "embedding")
    return vectors.knn(e.where("vec_id % 100 = 0"), e).select("query", "near", F.round("similarity", 6).alias("similarity"))


@query(
    """WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(1 - list_cosine_similarity(embedding::DOUBLE[], q.v), 6) AS distance FROM embeddings, q WHERE label = 3 ORDER BY distance, vec_id LIMIT 10"""
)
def knn_filtered(spark, t):
    """A top-k search with a filter on metadata before it."""
    e = t("embeddings").withColumn("brand", F.col("label").cast("string"))
    q = e.where("vec_id = 0").select("embedding").first()[0]
    return vectors.search(e, [float(x) for x in q], 10, "3", "vec_id").select("vec_id", F.round("distance", 6).alias("distance"))


@query(
    """SELECT doc_id, md5(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')) AS clean_md5, coalesce(length(text), 0) > 100 AS long_enough FROM documents"""
)
def text_sanitize(spark, t):
    """Texts without control characters, and the least length of a page."""
    return t("documents").select("doc_id", F.md5(specs.sanitize_text(F.col("text"))).alias("clean_md5"), (F.coalesce(F.length("text"), F.lit(0)) > R.MIN_PAGE).alias("long_enough"))


# --- HTML


def _html(t) -> DataFrame:
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.array_join(F.transform(F.split("text_content", "\n"), lambda x: F.concat(F.lit("<p>"), esc(x), F.lit("</p>"))), "")
    page = F.concat(F.lit("<html><head><title>"), esc(F.coalesce("title", F.lit(""))), F.lit("</title><style>p{}</style></head><body><nav><a href='/x'>menu</a></nav><script>if (a<b) c()</script>"), body, F.lit("<a href='/docs/a.PDF'>sheet</a><footer>foot</footer></body></html>"))
    return t("scraped_pages").where("text_content is not null").select("page_id", "url", page.alias("html"))


_STRIP = r"'^[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$'"


@query(
    f"""WITH l AS (SELECT page_id, regexp_replace(coalesce(title, ''), {_STRIP}, '', 'g') AS title, list_filter(list_transform(list_concat([coalesce(title, '')], string_split(text_content, chr(10)), ['sheet']), lambda x: regexp_replace(x, {_STRIP}, '', 'g')), lambda x: x <> '') AS lines FROM scraped_pages WHERE text_content IS NOT NULL)
    SELECT page_id, title, md5(array_to_string(lines, chr(10))) AS text_md5, CAST(length(array_to_string(lines, chr(10))) AS INTEGER) AS content_length FROM l"""
)
def html_text(spark, t):
    """Every page written as HTML and parsed back: title and text without menus, scripts, styles and footers."""
    p = _html(t).withColumn("p", html.parsed(F.col("html"), F.col("url")))
    return p.select("page_id", F.col("p.title").alias("title"), F.md5("p.text_content").alias("text_md5"), "p.content_length")


# --- events


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 59999999 MICROSECONDS PRECEDING AND CURRENT ROW) AS in_window FROM events")
def rate_window(spark, t):
    return limits.calls_in_window(t("events"), "user_id").select("event_id", "in_window")


_TUMBLING = "SELECT epoch_us(time_bucket(INTERVAL 10 MINUTES, ts)) AS start_us, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL"


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows over the stream of events, run to its end into files; a last event far ahead closes all windows, and is no result. Equal to the batch result."""
    tune(spark)
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex[:10]}"
    last = table(spark, sf_dir, "events").limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "ts" else F.lit("2200-01-01").cast(f.dataType).alias("ts") for f in schema])
    last.write.parquet(f"{base}/end")
    end = spark.readStream.schema(schema).parquet(f"{base}/end")
    windows = ingest.events_per_window(events.unionByName(end), delay="1 day")  # a filter here would go below the watermark
    windows.writeStream.outputMode("append").format("parquet").option("path", f"{base}/windows").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    w = spark.read.parquet(f"{base}/windows")
    return w.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("start_us"), "event_type", "events", F.round("value", 4).alias("value"))


QUERIES["stream_windows"], SQL["stream_windows"] = stream_windows, _TUMBLING


@query(_TUMBLING)
def batch_windows(spark, t):
    w = ingest.events_per_window(t("events"))
    return w.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("start_us"), "event_type", "events", F.round("value", 4).alias("value"))


@query(
    """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS fresh FROM events), b AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a)
    SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS events FROM b GROUP BY user_id, s"""
)
def user_sessions(spark, t):
    s = ingest.sessions(t("events"))
    return s.select("user_id", F.unix_micros(F.col("session_start").cast("timestamp")).alias("start_us"), "events")

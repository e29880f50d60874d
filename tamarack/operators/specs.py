"""Technical facts from free text and tables, their normalisation, range check, and the best per parameter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls
from ..session import spread
from . import qa
from .consensus import NUMERIC

TEXT_CONFIDENCE, TABLE_CONFIDENCE = 0.8, 0.9
#: White space beyond ASCII, read as blanks.
BLANKS = "\u00a0\u2002\u2003\u2007\u2009\u202f\u3000"


def sanitize_text(text: Column) -> Column:
    """Control characters dropped, except tab, line end and carriage return."""
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def plain_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, " " * len(BLANKS))


def canonical_unit(parameter: str, unit: Column) -> Column:
    """A unit as it is stored; the match is exact and case counts."""
    groups: dict[str, list[str]] = {}
    for spelling, canon in R.unit_spellings(parameter).items():
        groups.setdefault(canon, []).append(spelling)
    return reduce(lambda acc, kv: acc.when(unit.isin(*kv[1]), kv[0]), list(groups.items())[1:], F.when(unit.isin(*next(iter(groups.values()))), next(iter(groups)))).otherwise(unit)


def _matches(text: Column, p: R.Pattern) -> Column:
    """Array of struct(parameter, value, unit, seq) of a pattern's matches, in order."""
    rx = f"(?i){p.regex}" if p.regex.isascii() else f"(?iu){p.regex}"  # Unicode case folding is slow
    found = F.regexp_extract_all(text, F.lit(rx), 0)
    value = lambda m: F.replace(F.regexp_extract(m, rx, 1), F.lit(","), F.lit(""))
    unit = lambda m: canonical_unit(p.parameter, F.regexp_extract(m, rx, 2)) if p.has_unit else F.lit("")
    return F.transform(found, lambda m, i: F.struct(F.lit(p.parameter).alias("parameter"), value(m).alias("value"), unit(m).alias("unit"), (F.lit(p.seq) * 1_000_000 + i).cast("bigint").alias("seq")))


def from_text(pages: DataFrame, text: str = "text", url: str = "url", patterns: tuple[R.Pattern, ...] | None = None) -> DataFrame:
    """Facts in the texts of pages: their other columns with parameter, value, unit, seq and confidence.

    Every non-overlapping match of every pattern counts, in order of patterns; duplicates
    between patterns stay. Case is ignored in patterns but not in the spelling of units.
    Texts are read whole; null and empty ones have no facts.
    """
    patterns = patterns or R.patterns()
    keep = [c for c in pages.columns if c != text]
    t = plain_blanks(F.col(text))
    df = spread(pages.where(F.length(text) > 0)).withColumn("_t", t).withColumn("_l", F.lower("_t"))
    # one array per parameter: a single expression with all patterns would be too large a method
    names = list(dict.fromkeys(p.parameter for p in patterns))
    none = F.array().cast("array<struct<parameter:string,value:string,unit:string,seq:bigint>>")
    likely = lambda p: reduce(lambda a, b: a | b, [F.col("_l").contains(w) for w in p.needs])
    per = [F.flatten(F.array(*[F.when(likely(p), _matches(F.col("_t"), p)).otherwise(none) for p in patterns if p.parameter == n])).alias(f"_m_{i}") for i, n in enumerate(names)]
    # no filter on the array, and an outer explode: the planner would evaluate every pattern again for a filter below the projection
    found = df.select(*keep, F.flatten(F.array(*per)).alias("_m"))
    facts = found.select(*keep, F.explode_outer("_m").alias("_f")).where("_f is not null").select(*keep, "_f.parameter", "_f.value", "_f.unit", "_f.seq")
    return facts.withColumn("confidence", urls.source_confidence(TEXT_CONFIDENCE, F.col(url)))


def table_parameter(label: Column) -> Column:
    """The parameter that a trimmed lower-case label names: the longest known label it contains, null if none."""
    cases = R.labels()
    return reduce(lambda acc, x: acc.when(label.contains(x[0]), x[1]), cases[1:], F.when(label.contains(cases[0][0]), cases[0][1]))


def split_value_unit(raw: Column) -> tuple[Column, Column]:
    """Number without commas and the rest; the raw text and "" where it doesn't begin with a number."""
    rx = r"^([0-9,.]+)\s*(.*)"
    number = F.regexp_extract(raw, rx, 1)
    has = number != ""
    return F.when(has, F.replace(number, F.lit(","), F.lit(""))).otherwise(raw), F.when(has, F.trim(F.regexp_extract(raw, rx, 2))).otherwise("")


def from_tables(pages: DataFrame, tables: str = "tables", url: str = "url") -> DataFrame:
    """Facts in the tables of pages (array of tables of rows of cells): their other columns with parameter, value, unit, seq and confidence.

    A first row that contains a heading's word is a header. The unit comes from the column
    that the header names, else from a third cell of at most six characters, else from the
    value's cell. Null cells are empty; rows of fewer than two cells, blank and unknown
    labels give nothing.
    """
    keep = [c for c in pages.columns if c != tables]
    t = pages.select(*keep, F.posexplode(tables).alias("_ti", "_table")).where(F.size("_table") > 0)
    lower = lambda row: F.transform(row, lambda c: F.lower(F.trim(plain_blanks(F.coalesce(c, F.lit(""))))))
    first = F.col("_table")[0]
    header = F.array_join(lower(first), " ").rlike("|".join(R.HEADER_WORDS))
    unit_at = F.filter(F.transform(lower(first), lambda c, i: F.when(c.isin(*R.UNIT_HEADERS), i)), lambda i: i.isNotNull())
    t = t.withColumn("_unit", F.when(header, F.get(unit_at, F.lit(0)))).withColumn("_header", header)
    rows = t.select(*keep, "_ti", "_unit", "_header", F.posexplode("_table").alias("_ri", "_row")).where(~(F.col("_header") & (F.col("_ri") == 0)) & (F.size("_row") >= 2))
    cell = lambda i: F.trim(plain_blanks(F.coalesce(F.get("_row", i), F.lit(""))))
    param = table_parameter(F.lower(cell(F.lit(0))))
    value, extra = split_value_unit(cell(F.lit(1)))
    n, third, named = F.size("_row"), cell(F.lit(2)), cell(F.col("_unit"))
    unit = (
        F.when((n >= 3) & (F.col("_unit") < n), F.when(named != "", named).otherwise(extra))
        .when((n >= 3) & (third != "") & (F.length(third) <= 6), third)
        .otherwise(extra)
    )
    facts = rows.select(*keep, param.alias("parameter"), value.alias("value"), unit.alias("unit"), (F.col("_ti").cast("bigint") * 1_000_000 + F.col("_ri")).alias("seq")).where("parameter is not null")
    return facts.withColumn("confidence", urls.source_confidence(TABLE_CONFIDENCE, F.col(url), True))


def normalize(specs: DataFrame) -> DataFrame:
    """Kilograms to tons for weights (two decimals), millimetres to metres for dimensions (three); other rows stay as they are."""
    v = F.when(F.col("value").rlike(NUMERIC), F.trim("value").try_cast("double"))
    kg = F.col("parameter").isin(*R.KG_TO_TON) & (F.col("unit") == "kg") & v.isNotNull()
    mm = F.col("parameter").isin(*R.MM_TO_M) & (F.col("unit") == "mm") & v.isNotNull()
    value = F.when(kg, F.round(v / 1000, 2).cast("string")).when(mm, F.round(v / 1000, 3).cast("string")).otherwise(F.col("value"))
    unit = F.when(kg, "ton").when(mm, "m").otherwise(F.col("unit"))
    return specs.withColumns({"value": value, "unit": unit})


def check_range(specs: DataFrame, low_confidence: float = 0.3) -> DataFrame:
    """Confidence falls to 0.3 where a number is outside the range of its parameter and unit."""
    df = qa.with_range(specs)
    v = F.when(F.col("value").rlike(NUMERIC), F.trim("value").try_cast("double"))
    outside = F.coalesce(~v.between(F.col("lo"), F.col("hi")), F.lit(False))
    return df.withColumn("confidence", F.when(outside, F.lit(low_confidence)).otherwise(F.col("confidence"))).drop("lo", "hi").select(*specs.columns)


def best_per_parameter(specs: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Per keys and parameter the first of the most confident facts, after normalising and range check. Partial aggregation keeps one row per mapper and group."""
    ready = check_range(normalize(specs))
    rest = [c for c in ready.columns if c not in (*keys, "parameter")]
    best = F.max_by(F.struct(*rest), F.struct("confidence", (-F.col(order)).alias("o")))
    return ready.groupBy(*keys, "parameter").agg(best.alias("_b")).select(*keys, "parameter", *[F.col(f"_b.{c}").alias(c) for c in rest])


def profile(pages: DataFrame, keys: list[str], text: str = "text", tables: str = "tables", url: str = "url") -> DataFrame:
    """The profile of each page: facts of its tables before those of its text, the best per parameter."""
    plain, tabled = pages.drop(tables), pages.drop(text)
    facts = from_tables(tabled, tables, url).unionByName(from_text(plain, text, url).withColumn("seq", F.col("seq") + 10**12))
    return best_per_parameter(facts, keys)

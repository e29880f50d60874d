"""Force-per-gear curves: from tables and text, checks, and consensus across sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls
from .consensus import NUMERIC, _same, clustered, main_cluster, rated

_FORCE = "kN|lbf|kgf|lb"
# Families of patterns in texts: a gear before or after the word, a gear in brackets, and lists of ordinals in a section.
FAMILY_1 = rf"(?:(\w+)\s*(?:gear|marcha)\s*rimpull|rimpull\s*\(?(\w+)\s*(?:gear|marcha)\)?)[:\s]*([0-9,.]+)\s*({_FORCE})"
FAMILY_2 = rf"rimpull\s*\(\s*(\w+)(?:\s*gear)?\s*\)[:\s]*([0-9,.]+)\s*({_FORCE})"
SECTION = rf"rimpull[^.]{{0,500}}?(?:(?:\d+(?:st|nd|rd|th))[:\s]+[0-9,.]+\s*(?:{_FORCE})[\s,;]*)+"
INLINE = rf"(\d+(?:st|nd|rd|th))[:\s]+([0-9,.]+)\s*({_FORCE})"


def normalize_gear(gear: Column) -> Column:
    """The standard name of a gear; a trimmed unknown one as it is."""
    key = F.regexp_replace(F.lower(F.trim(gear)), r"\.+$", "")
    names = list(R.GEARS.items())
    known = reduce(lambda acc, kv: acc.when(key.isin(*kv[1]), kv[0]), names[1:], F.when(key.isin(*names[0][1]), names[0][0]))
    return known.otherwise(F.trim(gear))


def gear_rank(gear: Column) -> Column:
    return F.coalesce(*[F.when(gear == g, F.lit(r)) for g, r in R.GEAR_RANK.items()], F.lit(99))


def to_kn(value: Column, unit: Column) -> Column:
    u = F.lower(F.trim(unit))
    return F.when(u.isin("lbf", "lb"), value / R.LBF_PER_KN).when(u == "kgf", value / R.KGF_PER_KN).otherwise(value)


def force_unit(text: Column) -> Column:
    """The unit that a heading names: pounds go before kgf, kN is the default."""
    t = F.lower(text)
    return F.when(t.contains("lb"), "lbf").when(t.contains("kgf"), "kgf").otherwise("kN")


def _number(text: Column) -> Column:
    plain = F.trim(F.replace(text, F.lit(","), F.lit("")))
    return F.when(plain.rlike(NUMERIC), plain.try_cast("double"))


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def is_curve_table(table: Column) -> Column:
    """Whether a table (array of rows) holds a curve: its first two rows name a gear or speed and a force, or two rows begin with gears and a number stands elsewhere."""
    empty = F.lit("")
    words = lambda rows: F.lower(F.array_join(F.flatten(F.transform(rows, lambda r: F.transform(r, lambda c: F.coalesce(c, empty)))), " "))
    head = words(F.slice(table, 1, 2))
    body = F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(1)))
    gears = F.size(F.filter(body, lambda r: (F.size(r) > 0) & (gear_rank(normalize_gear(F.coalesce(F.get(r, F.lit(0)), empty))) < 99)))
    numbers = F.exists(body, lambda r: F.exists(F.slice(r, 2, F.greatest(F.size(r), F.lit(1))), lambda c: _number(c).isNotNull()))
    return F.coalesce((F.size(table) >= 2) & ((_any(head, R.GEAR_WORDS) & _any(head, R.FORCE_WORDS)) | ((gears >= 2) & numbers)), F.lit(False))


def _sorted(points: Column) -> Column:
    """Points in the order of gears, as they came within a gear; points: array of struct(seq, gear, ...)."""
    return F.transform(F.array_sort(F.transform(points, lambda p: F.struct(gear_rank(p["gear"]).alias("rank"), p["seq"].alias("seq"), p.alias("p")))), lambda x: x["p"])


_POINT = ("seq", "gear", "speed_kmh", "force_kn", "original_unit")


def from_tables(pages: DataFrame, tables: str = "tables", url: str = "url") -> DataFrame:
    """Points of curves in tables: the pages' other columns with curve_no, seq, gear, speed_kmh, force_kn, original_unit and confidence.

    Without a named column the gear stands first and the force in the first column left over,
    or in the last. Rows whose force isn't a number fall out; a curve has two points or more.
    """
    keep = [c for c in pages.columns if c != tables]
    t = pages.select(*keep, F.posexplode(tables).alias("curve_no", "_t")).where(is_curve_table(F.col("_t")))
    cells = F.transform(F.col("_t")[0], lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    kind = lambda c: F.when(_any(c, ("gear", "marcha")), "g").when(_any(c, R.SPEED_WORDS), "s").when(_any(c, R.FORCE_WORDS), "f")
    at = lambda k: F.array_max(F.transform(cells, lambda c, i: F.when(kind(c) == k, i)))
    width = F.size(cells)
    gear = F.coalesce(at("g"), F.lit(0))
    left = F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda i: F.when((i != F.col("_g")) & (i != F.col("_s")), i)))
    t = t.withColumn("_g", gear).withColumn("_s", at("s")).withColumn("_u", force_unit(F.array_join(cells, " ")))
    t = t.withColumn("_f", F.coalesce(at("f"), F.when(F.col("_s").isNotNull(), F.coalesce(left, width - 1)), width - 1))
    rows = t.select(*keep, "curve_no", "_g", "_s", "_f", "_u", F.posexplode("_t").alias("seq", "_r")).where("seq > 0")
    label = F.trim(F.get("_r", F.col("_g")))
    force = _number(F.get("_r", F.col("_f")))
    points = rows.where((F.size("_r") > F.greatest("_g", "_f")) & (label != "") & force.isNotNull()).select(
        *keep, "curve_no", "seq", normalize_gear(label).alias("gear"), _number(F.get("_r", F.col("_s"))).alias("speed_kmh"), F.round(to_kn(force, F.col("_u")), 2).alias("force_kn"), F.col("_u").alias("original_unit")
    )
    lists = points.groupBy(*keep, "curve_no").agg(F.collect_list(F.struct(*_POINT)).alias("_points")).where(F.size("_points") >= 2)
    return _exploded(lists, [*keep, "curve_no"], urls.source_confidence(0.9, F.col(url), True))


def _exploded(lists: DataFrame, keep: list[str], confidence: Column) -> DataFrame:
    return lists.select(*keep, F.posexplode(_sorted(F.col("_points"))).alias("seq", "_x")).select(*keep, "seq", *[F.col(f"_x.{c}").alias(c) for c in _POINT[1:]]).withColumn("confidence", confidence)


def from_text(pages: DataFrame, text: str = "text", url: str = "url") -> DataFrame:
    """Points of the one curve that a text may hold: the other columns with seq, gear, speed_kmh (null), force_kn, original_unit and confidence.

    The first family of patterns isn't checked against itself; of the other two a point
    falls out if its gear already has a force within 0.1 kN. A curve has two points or more.
    """
    keep = [c for c in pages.columns if c != text]
    t = F.col(text)
    ci = "(?iu)"

    def points(found: Column, rx: str, gears: tuple[int, ...], value: int) -> Column:
        got = lambda m, g: F.regexp_extract(m, ci + rx, g)
        gear = lambda m: F.coalesce(*[F.when(got(m, g) != "", got(m, g)) for g in gears])
        kn = lambda m: to_kn(_number(got(m, value)), got(m, value + 1))
        made = F.transform(found, lambda m: F.struct(F.lit(0).alias("seq"), normalize_gear(gear(m)).alias("gear"), F.lit(None).cast("double").alias("speed_kmh"), F.round(kn(m), 2).alias("force_kn"), got(m, value + 1).alias("original_unit"), kn(m).alias("exact")))
        return F.filter(made, lambda p: p["force_kn"].isNotNull())

    every = lambda rx: F.regexp_extract_all(t, F.lit(ci + rx), 0)
    inline = F.flatten(F.transform(every(SECTION), lambda s: F.regexp_extract_all(s, F.lit(ci + INLINE), 0)))
    first, rest = points(every(FAMILY_1), FAMILY_1, (1, 2), 3), F.concat(points(every(FAMILY_2), FAMILY_2, (1,), 2), points(inline, INLINE, (1,), 2))
    add = lambda acc, p: F.when(F.exists(acc, lambda q: (q["gear"] == p["gear"]) & (F.abs(q["force_kn"] - p["exact"]) < 0.1)), acc).otherwise(F.concat(acc, F.array(p)))
    df = pages.where(F.col(text).rlike(f"{ci}rimpull")).select(*keep, first.alias("_a"), rest.alias("_b")).select(*keep, F.aggregate("_b", F.col("_a"), add).alias("_points"))
    numbered = F.transform("_points", lambda p, i: F.struct(i.alias("seq"), *[p[c].alias(c) for c in _POINT[1:]]))
    return _exploded(df.where(F.size("_points") >= 2).withColumn("_points", numbered), keep, urls.source_confidence(0.8, F.col(url)))


def check(points: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid points, report per curve) of points(keys..., gear, speed_kmh, force_kn, ...).

    A point needs a force of 50 to 2,000 kN and, if it has one, a speed above 0 and up to 80
    km/h; a curve two valid points. The force of forward gears mustn't rise from one gear to
    the next; rises are counted, not rejected.
    """
    force, speed = F.col("force_kn"), F.col("speed_kmh")
    issue = F.when(force == 0, "zero").when(~force.between(50, 2000) | force.isNull(), "force").when(speed.isNotNull() & ~((speed > 0) & (speed <= 80)), "speed").otherwise("")
    rated = points.withColumn("issue", issue).withColumn("rank", gear_rank(normalize_gear(F.col("gear"))))
    order = "seq" if "seq" in points.columns else "force_kn"
    along = Window.partitionBy(*keys).orderBy("rank", order)
    forward = rated.where((F.col("issue") == "") & (F.col("gear") != "Reverse")).withColumn("before", F.lag("force_kn").over(along))
    rises = forward.groupBy(*keys).agg(F.count_if(force > F.col("before")).cast("bigint").alias("rises"))
    count = lambda c: F.count_if(c).cast("bigint")
    counts = rated.groupBy(*keys).agg(F.count("*").alias("total_input"), count(F.col("issue") == "").alias("total_valid"), *[count(F.col("issue") == i).alias(f"bad_{i}") for i in ("zero", "force", "speed")])
    on = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])
    report = counts.join(rises, on(counts, rises), "left").select(*[counts[k] for k in keys], "total_input", "total_valid", "bad_zero", "bad_force", "bad_speed", (F.col("total_valid") >= 2).alias("passed"), F.coalesce("rises", F.lit(0)).cast("bigint").alias("rises"))
    enough = report.where("passed").select(*keys)
    ok = rated.where(F.col("issue") == "")
    return ok.join(enough, on(ok, enough), "left_semi").drop("issue"), report


def consensus(points: DataFrame, machine: list[str], curve: str) -> DataFrame:
    """One curve per machine from the points of several: (machine..., gear, speed_kmh, force_kn, original_unit, confidence, source_url).

    The points of a gear are clustered within 10 %; the largest cluster's most confident
    point counts (then lower force, source), its confidence raised by a tenth of the share
    that agrees and at most 0.85 where some don't; the speed is the cluster's mean. A machine
    of one curve keeps it; fewer than two points give none. Points without a force don't
    count, those without address are one source, null confidences are 0. Points are counted
    per force before the shuffle, so no gear's points are gathered.
    """
    p = points.select(*machine, normalize_gear(F.col("gear")).alias("gear"), "speed_kmh", "force_kn", "original_unit", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("source_url", F.lit("")).alias("source_url"), F.coalesce(F.col(curve).cast("string"), F.lit("")).alias("_curve"))
    by = [*machine, "gear"]
    best = F.min(F.struct((-F.col("confidence")).alias("c"), "v", "source_url", "original_unit", "speed_kmh")).alias("best")
    speed = F.when(~F.isnan("speed_kmh"), F.col("speed_kmh"))
    values = p.withColumn("v", F.col("force_kn").cast("double")).where("v is not null").groupBy(*by, "v").agg(F.count("*").alias("n"), best, F.sum(speed).alias("s"), F.count(speed).alias("sn"))
    g = main_cluster(clustered(values.withColumn("percent", F.lit(R.CURVE_TOLERANCE)), by), by, s=F.col("s"), sn=F.col("sn"))
    single = F.col("numbers") == 1
    conf = F.when(single, -F.col("best.c")).otherwise(rated(-F.col("best.c"), F.col("agree"), F.col("numbers"), F.col("clusters") > 1))
    mean = F.when(single, F.col("best.speed_kmh")).otherwise(F.when(F.col("sn") > 0, F.round(F.round(F.col("s") / F.col("sn"), 9), 1)))
    out = g.select(*by, mean.alias("speed_kmh"), F.round("best.v", 2).alias("force_kn"), F.col("best.original_unit").alias("original_unit"), conf.alias("confidence"), F.col("best.source_url").alias("source_url"))
    # a machine of one curve keeps its points
    curves = p.groupBy(*machine).agg(F.count_distinct("_curve").alias("_curves"))
    on = lambda a, b: _same([(a[m], b[m]) for m in machine])
    ones = curves.where("_curves = 1").drop("_curves")
    made = out.join(ones, on(out, ones), "left_anti")
    kept = p.join(ones, on(p, ones), "left_semi").select(*out.columns)
    every = made.unionByName(kept)
    enough = every.groupBy(*machine).agg(F.count("*").alias("_n")).where("_n >= 2").drop("_n")
    return every.join(enough, on(every, enough), "left_semi")

"""Consensus across sources: clustering of values by a running mean, and one result per group.

A group is what different sources say about one parameter of one machine. Its rows are
counted per value before anything is shuffled. The different values, sorted, are walked
through once with a running sum, which gives the values that clusters start with; a group
of more than ``GATHERED`` different values is walked through row by row instead of in an
array. Everything else is ordinary aggregation of values and clusters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..session import materialize

NUMERIC = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def numeric_value(value: Column) -> Column:
    """A value as a number, commas deleted; null where it isn't one."""
    plain = F.replace(value, F.lit(","), F.lit(""))
    return F.when(plain.rlike(NUMERIC), F.trim(plain).try_cast("double"))


def tolerance(parameter: Column) -> Column:
    return F.coalesce(*[F.when(parameter == k, F.lit(v)) for k, v in R.TOLERANCES.items()], F.lit(R.TOLERANCE))


#: Different values of a group that are folded in one array.
GATHERED = 100_000


class Walk:
    """The running cluster of a group's positive values in order: a value joins it if it is within ``percent`` of its mean."""

    def __init__(self):
        self.group, self.sum, self.count = None, 0.0, 0

    def __call__(self, group: str, value: float, n: int, percent: float) -> bool:
        """Whether a value that stands n times starts a cluster."""
        if group != self.group:
            self.group, self.count = group, 0
        new = not self.count or not abs(value - self.sum / self.count) / (self.sum / self.count) * 100 <= percent
        self.sum, self.count = (0.0, 0) if new else (self.sum, self.count)
        self.sum, self.count = self.sum + value * n, self.count + n
        return new


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walk = Walk()
    for b in batches:
        columns = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("_g", "v", "n", "percent")]
        yield b.filter(pa.array([walk(*row) for row in zip(*columns)], pa.bool_()))


def _starts_in_rows(values: DataFrame, keys: list[str]) -> DataFrame:
    df = values.withColumn("_g", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})).select(*keys, "_g", "v", "n", "percent")
    df = df.repartition(*keys).sortWithinPartitions("_g", "v")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(_walked, schema).groupBy(*keys).agg(F.array_sort(F.collect_list("v")).alias("starts"))


def _starts_in_arrays(values: DataFrame, keys: list[str]) -> DataFrame:
    g = values.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("vs"), F.first("percent").alias("percent"))
    none = F.filter(F.transform("vs", lambda x: x["v"]), lambda _: F.lit(False))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("bigint").alias("n"), none.alias("starts"))

    def step(acc, x):
        mean = acc["sum"] / acc["n"]
        fits = F.coalesce((acc["n"] > 0) & (F.abs(x["v"] - mean) / mean * 100 <= F.col("percent")), F.lit(False))
        more = F.struct((acc["sum"] + x["v"] * x["n"]).alias("sum"), (acc["n"] + x["n"]).alias("n"), acc["starts"].alias("starts"))
        new = F.struct((x["v"] * x["n"]).alias("sum"), x["n"].alias("n"), F.concat(acc["starts"], F.array(x["v"])).alias("starts"))
        return F.when(fits, more).otherwise(new)

    return g.select(*keys, F.aggregate("vs", start, step)["starts"].alias("starts"))


def clustered(values: DataFrame, keys: list[str]) -> DataFrame:
    """values(keys..., v, n, percent, ...), a row per value, with the value that its cluster starts with; values of zero or less are clusters of their own. percent is below 100."""
    values = materialize(values, "values")
    positive = values.where("v > 0").select(*keys, "v", "n", "percent")
    sizes = positive.groupBy(*keys).count()
    large = sizes.where(F.col("count") > GATHERED).select(*keys)
    if large.limit(1).count():
        on = lambda a, b: _same([(a[k], b[k]) for k in keys])
        starts = _starts_in_rows(positive.join(large, on(positive, large), "left_semi"), keys).unionByName(_starts_in_arrays(positive.join(large, on(positive, large), "left_anti"), keys))
    else:
        starts = _starts_in_arrays(positive, keys)
    v, s = values.alias("v"), starts.alias("s")
    joined = v.join(s, _same([(F.col(f"v.{k}"), F.col(f"s.{k}")) for k in keys]), "left").select("v.*", "s.starts")
    own = F.when(F.col("v") > 0, F.array_max(F.filter("starts", lambda x: x <= F.col("v")))).otherwise(F.col("v"))
    return joined.withColumn("cluster", own).drop("starts")


def main_cluster(labelled: DataFrame, keys: list[str], **sums: Column) -> DataFrame:
    """Per group: agree, lo, hi, best and the named sums of its largest cluster (of equal ones the first), numbers (its values in all) and clusters."""
    apart = F.col("v") <= 0  # each a cluster of its own, however often it stands
    per = labelled.groupBy(*keys, "cluster").agg(F.sum(F.when(apart, 1).otherwise(F.col("n"))).alias("agree"), F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("best").alias("best"), *[F.sum(c).alias(k) for k, c in sums.items()])
    chosen = F.max_by(F.struct("agree", "lo", "hi", "best", *sums), F.struct("agree", (-F.col("cluster")).alias("c"))).alias("_main")
    g = per.groupBy(*keys).agg(chosen, F.sum("n").alias("numbers"), F.sum(F.when(F.col("cluster") <= 0, F.col("n")).otherwise(1)).alias("clusters"))
    return g.select(*keys, "_main.*", "numbers", "clusters")


def rated(best: Column, agree: Column, n: Column, conflict: Column) -> Column:
    """The best one's confidence raised by a tenth of the agreeing share, at most 0.85 in a conflict; three decimals."""
    raised = F.least(best + 0.1 * agree / n, F.lit(1.0))
    return F.round(F.round(F.when(conflict, F.least(raised, F.lit(0.85))).otherwise(raised), 9), 3)


def _decimals(values: Column) -> Column:
    """Numbers with one decimal, rounded as their exact binary values are; the JVM's formats round the shortest decimal form, which differs where that ends in 5."""

    def one(x: Column) -> Column:
        shown = F.format_string("%.1f", x)
        tenths = F.floor(F.abs(x) * 10)
        # of a number that looks like a tie, what twenty times its binary value exceeds the tie by: the sum of 16 x and 4 x, which are exact, and that sum's rounding error
        a, b = F.abs(x) * 16, F.abs(x) * 4
        excess = (a + b - (tenths * 2 + 1)) + (b - ((a + b) - a))
        tie = F.abs(F.abs(x) * 10 - tenths - 0.5) < 1e-9
        down = F.format_string("%.1f", F.signum(x) * tenths / 10)
        even = (excess == 0) & (tenths % 2 == 0)
        return F.when(tie & ((excess < 0) | even), down).otherwise(shown)

    return F.array_join(F.transform(F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x)), one), ", ")


def consensus(candidates: DataFrame, keys: list[str] | None = None, lists: bool = True) -> DataFrame:
    """One row per group of candidates(keys..., parameter, value, unit, confidence, source_url, seq).

    Values that are numbers are clustered within the parameter's tolerance; the largest
    cluster (of equal ones that of the lowest values) is the consensus, its most confident
    value (then the lower value, source and seq) the result; confidence rises by a tenth
    of the agreeing share, and is at most 0.85 where some disagree. Groups of texts alone
    take the most confident. A group of one is taken as it is. Units aren't compared. Null
    confidences count as 0, null keys are a group; an empty table gives an empty result.
    ``lists`` adds sources (of the values that agree, in order of value) and conflict_detail,
    which are as long as their groups are large; without them no group is gathered.
    """
    keys = [*(keys or ["brand", "model"]), "parameter"]
    seq = F.col("seq") if "seq" in candidates.columns else F.lit(0)
    conf = F.coalesce(F.col("confidence").cast("double"), F.lit(0.0))
    rows = candidates.select(*keys, numeric_value(F.col("value")).alias("v"), "value", "unit", "source_url", conf.alias("confidence"), seq.alias("seq"))
    word = F.when(F.col("v").isNull(), F.lower("value")).alias("word")
    best = F.min(F.struct((-F.col("confidence")).alias("c"), F.when(F.col("v").isNotNull(), F.col("v")).alias("v"), "source_url", "seq", "value", "unit")).alias("best")
    values = rows.groupBy(*keys, "v", word).agg(F.count("*").alias("n"), best)
    number = values.where("v is not null").withColumn("percent", tolerance(F.col("parameter")))
    main = main_cluster(clustered(number, keys), keys)
    texts = values.where("v is null").groupBy(*keys).agg(F.sum("n").alias("texts"), F.count("*").alias("words"), F.min("best").alias("said"))
    m, t = main.alias("m"), texts.alias("t")
    on = lambda a, b: _same([(F.col(f"{a}.{k}"), F.col(f"{b}.{k}")) for k in keys])
    g = m.join(t, on("m", "t"), "full").select(*[F.coalesce(f"m.{k}", f"t.{k}").alias(k) for k in keys], *[F.col(f"m.{c}") for c in ("agree", "lo", "hi", "best", "numbers", "clusters")], "texts", "words", "said")
    all_text = F.col("numbers").isNull()
    n = F.coalesce("numbers", F.lit(0)) + F.coalesce("texts", F.lit(0))
    pick = F.when(all_text, F.col("said")).otherwise(F.col("best"))
    conflict = F.coalesce(F.col("clusters") > 1, F.lit(False))
    g = g.select(*keys, "lo", "hi", "agree", "numbers", conflict.alias("conflict"), all_text.alias("all_text"), "words", n.alias("n"), pick.alias("pick"))
    single = F.col("n") == 1
    final = F.when(single | F.col("all_text"), -F.col("pick.c")).otherwise(rated(-F.col("pick.c"), F.col("agree"), F.col("n"), F.col("conflict")))
    agreed = F.when(single, True).when(F.col("all_text"), F.col("words") == 1).otherwise(~F.col("conflict"))
    out = g.select(*keys, F.col("pick.value").alias("best_value"), F.col("pick.unit").alias("best_unit"), final.alias("final_confidence"), F.col("n").cast("int").alias("source_count"), agreed.alias("consensus"), "lo", "hi", "all_text", "agree", "conflict", "pick")
    if not lists:
        return out.select(*keys, "best_value", "best_unit", "final_confidence", "source_count", "consensus")
    o, r = out.alias("o"), rows.alias("r")
    inside = F.col("o.all_text") | F.col("r.v").between(F.col("o.lo"), F.col("o.hi"))
    item = F.struct(F.col("r.v").alias("v"), F.col("r.source_url").alias("source_url"), F.col("r.seq").alias("seq"))
    each = o.join(r, on("o", "r")).select("o.*", F.when(F.coalesce(inside, F.lit(False)), item).alias("in"), F.when(~inside, item).alias("out"))
    made = each.groupBy(*[c for c in out.columns]).agg(F.array_sort(F.collect_list("in")).alias("ins"), F.array_sort(F.collect_list("out")).alias("outs"))
    outliers = F.transform("outs", lambda x: x["v"])
    detail = F.when(
        F.col("conflict") & ~F.col("all_text"),
        F.concat(F.lit("Conflict: "), F.col("agree").cast("string"), F.lit("/"), F.col("source_count").cast("string"), F.lit(" sources agree on ~"), _decimals(F.array(F.col("pick.v"))), F.lit(". Outliers: "), _decimals(outliers)),
    ).otherwise("")
    return made.select(*keys, "best_value", "best_unit", "final_confidence", "source_count", "consensus", F.transform("ins", lambda x: x["source_url"]).alias("sources"), detail.alias("conflict_detail"))


def _same(pairs: list[tuple[Column, Column]]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & a.eqNullSafe(b)
    return out

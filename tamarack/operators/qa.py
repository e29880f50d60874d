"""Checks of extracted values: placeholders, numbers, ranges, completeness, physical constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from .consensus import numeric_value


def range_table(spark) -> DataFrame:
    """(parameter, unit, lo, hi): as many rows as :data:`tamarack.functions.rules.RANGES` has."""
    rows = [(p, u, float(lo), float(hi)) for p, units in R.RANGES.items() for u, (lo, hi) in units.items()]
    return spark.createDataFrame(rows, "parameter string, unit string, lo double, hi double")


def with_range(specs: DataFrame) -> DataFrame:
    """Adds lo and hi, null where the parameter has no range in that unit."""
    return specs.join(F.broadcast(range_table(specs.sparkSession)), ["parameter", "unit"], "left")


def check(specs: DataFrame) -> DataFrame:
    """Adds issue (the reason of a rejection: empty, placeholder, not_numeric, out_of_range, or ""), unit_missing and passed.

    A value is out of range below half of the range or above twice of it. A missing unit of a
    numeric parameter is only a warning. Null values are empty.
    """
    df = with_range(specs)
    v = F.trim("value")
    text = F.col("parameter").isin(*R.TEXT_PARAMETERS)
    num = numeric_value(v)
    issue = (
        F.when(F.coalesce(v, F.lit("")) == "", "empty")
        .when(v.rlike(R.PLACEHOLDER), "placeholder")
        .when(~text & num.isNull(), "not_numeric")
        .when(F.coalesce((num < F.col("lo") * 0.5) | (num > F.col("hi") * 2), F.lit(False)), "out_of_range")
        .otherwise("")
    )
    missing = ~text & (F.coalesce("unit", F.lit("")) == "") & ~issue.isin("empty", "placeholder", "not_numeric")
    return df.withColumn("issue", issue).withColumn("unit_missing", missing).withColumn("passed", F.col("issue") == "").drop("lo", "hi")


def core_parameters(equipment_type: Column) -> Column:
    """The parameters that a machine of this type must have."""
    t = F.lower(F.coalesce(equipment_type, F.lit("")))
    listed = lambda k: F.array(*map(F.lit, R.CORE[k]))
    return F.when(t.rlike("excav|pala|shovel"), listed("excavator")).when(t.rlike("cami|truck|haul"), listed("truck")).otherwise(listed("generic"))


def constraints(checked: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys..., lower, upper, lower_value, upper_value): pairs of parameters in one unit that break a rule; the last value by ``order`` counts."""
    last = Window.partitionBy(*keys, "parameter").orderBy(F.desc(order))
    names = sorted({p for pair in R.LESS_THAN for p in pair})
    latest = checked.where(F.col("passed") & F.col("parameter").isin(*names)).withColumn("_n", F.row_number().over(last)).where("_n = 1").withColumn("_v", numeric_value(F.col("value")))
    out = None
    for lower, upper in R.LESS_THAN:
        pick = lambda p: F.max(F.when(F.col("parameter") == p, F.struct("unit", F.col("_v").alias("v"))))
        pair = latest.groupBy(*keys).agg(pick(lower).alias("a"), pick(upper).alias("b"))
        bad = pair.where((F.col("a.unit") == F.col("b.unit")) & (F.col("a.v") >= F.col("b.v"))).select(*keys, F.lit(lower).alias("lower"), F.lit(upper).alias("upper"), F.col("a.v").alias("lower_value"), F.col("b.v").alias("upper_value"))
        out = bad if out is None else out.unionByName(bad)
    return out


def report(specs: DataFrame, keys: list[str], equipment_type: str | None = None) -> DataFrame:
    """Per group of keys: counts of specs, rejection rate in per cent, completeness of the core parameters, the missing ones, and counts of each issue."""
    kind = F.first(F.col(equipment_type), ignorenulls=True) if equipment_type else F.lit(None).cast("string")
    ok = F.col("passed")
    count = lambda c: F.count_if(c).cast("bigint")
    g = check(specs).groupBy(*keys).agg(
        F.count("*").alias("total_input"), count(ok).alias("total_valid"), count(~ok).alias("total_rejected"), count(ok & F.col("unit_missing")).alias("warnings"),
        *[count(F.col("issue") == i).alias(i) for i in ("empty", "placeholder", "not_numeric", "out_of_range")],
        F.collect_set(F.when(ok, F.col("parameter"))).alias("found"), kind.alias("kind"),
    )
    core = core_parameters(F.col("kind"))
    missing = F.array_sort(F.array_except(core, F.col("found")))
    return g.select(
        *keys, "total_input", "total_valid", "total_rejected", F.round(F.col("total_rejected") / F.col("total_input") * 100, 1).alias("rejection_rate"),
        F.round(F.size(F.array_intersect(core, F.col("found"))) / F.size(core), 2).alias("completeness"), missing.alias("missing_core"), "warnings", "empty", "placeholder", "not_numeric", "out_of_range",
    )

"""Quantities recorded in different units: conversion to each parameter's common unit.

A hidden Markov model runs over each device's series of a parameter. The hidden state is
the unit its records are written in, the time step a calendar month. Records that state
their unit, or stand inside the parameter's plausible band, say the state outright; a bare
number outside the band says it through the jump of its log value against the level of the
labelled records, which is smoothed over the steps. Viterbi decodes the states, and every
undecided record then takes the unit that its own value and its step's state make most
probable.

Steps are aggregated before the shuffle (counts and moments per unit, so a device holding
a third of all rows costs each mapper one row a month), hence a chain is never longer than
the number of months; the records themselves are never gathered by device.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quantity as Q
from ..session import materialize

#: Log probabilities of a change of unit between months, and of a record against its month's unit.
SWITCH, AGAINST = np.log(0.05), np.log(0.02)
#: Standard deviation of log values about the level, and weight kept from the month before.
SIGMA, SMOOTH = 1.2, 0.7


def common_units(catalog: DataFrame) -> DataFrame:
    """Per parameter with a known common unit: numbers of its dimension and unit, band, unit states and factors.

    The catalogue is a dimension table of one row per parameter.
    """
    spark = catalog.sparkSession
    rows = []
    for d, (_, units) in enumerate(Q.UNITS.items()):
        for i, (canon, (_, spellings)) in enumerate(units.items()):
            names, factors = Q.states(canon)
            rows += [(s, d, i, list(names), list(factors)) for s in dict.fromkeys((canon, canon.lower(), *spellings))]
    seen: dict[str, tuple] = {}
    for r in rows:
        seen.setdefault(r[0], r)  # "kg" is a mass before it is a force
    units = spark.createDataFrame(list(seen.values()), "cu string, dim int, common int, states array<string>, factors array<double>")
    return (
        catalog.where(F.col("common_unit").isNotNull())
        .select("parameter", F.trim("common_unit").alias("cu"), F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))
        .dropDuplicates(["parameter"])
        .join(F.broadcast(units), "cu")
        .drop("cu")
    )


def _read_batches(batches: Iterator[pa.RecordBatch], keep: list[str], bare_is_common: bool, mixed: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        number = lambda c, null: pc.fill_null(b.column(c), null).to_numpy(zero_copy_only=False)
        cols = Q.read(b.column("value"), b.column("unit"), b.column("hint"), number("dim", -1), number("common", -1), number("low", np.nan), number("high", np.nan), bare_is_common, mixed)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *cols.values()], names=[*keep, *cols])


def read_records(records: DataFrame, catalog: DataFrame, bare_is_common: bool = False, mixed: bool = True) -> DataFrame:
    """Read the quantities of records(parameter, value string, unit string, hint string, ...).

    ``unit`` is the unit a record claims for its value; ``hint`` a unit it once had, which
    says nothing certain. mixed: numbers come in several styles. All columns stay but the hint; added are those of
    :func:`tamarack.functions.quantity.read`. Parameters without common unit have null idx.
    """
    keep = [c for c in records.columns if c != "hint"]
    dims = common_units(catalog).select("parameter", "dim", "common", "low", "high")
    df = records.join(F.broadcast(dims), "parameter", "left").select(*records.columns, "dim", "common", "low", "high")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in records.select(*keep).schema), Q.READ_FIELDS])
    return df.mapInArrow(lambda it: _read_batches(it, keep, bare_is_common, mixed), schema)


def spec_records(specs: DataFrame) -> DataFrame:
    return specs.select(F.lit("spec").alias("record_kind"), F.col("id").cast("bigint").alias("record_id"), F.col("equipment_id").cast("bigint").alias("device"), "parameter", "value", "unit", F.lit(None).cast("string").alias("hint"), F.col("extracted_at").alias("ts"))


def point_records(points: DataFrame, parameter: str = "rimpull_maximo") -> DataFrame:
    """Force points as records: the original unit is the unit only where it is kN, else a hint."""
    unit = F.lower(F.trim("original_unit"))
    kn = unit.isin(*Q.UNITS["force"]["kN"][1])
    return points.select(
        F.lit("point").alias("record_kind"), F.col("id").cast("bigint").alias("record_id"), F.col("equipment_id").cast("bigint").alias("device"), F.lit(parameter).alias("parameter"),
        F.col("force_kn").cast("string").alias("value"), F.when(kn, F.lit("kN")).alias("unit"), unit.alias("hint"), F.col("extracted_at").alias("ts"),
    )


def _viterbi(hard, n_bare, s1, s2, fit, level0, logf, first):
    """Decode many chains at once, step by step.

    hard, fit: (n, S); n_bare, s1, s2, level0: (n,); logf: (n, S) log factors; first: chain
    starts. Returns the state and the smoothed level of each row.
    """
    n = len(first)
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, n))
    state, level = np.zeros(n, np.int8), np.zeros(n)
    if not n:
        return state, level
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0])
    back = np.zeros((n, Q.STATES), np.int8)
    score = np.zeros((len(starts), Q.STATES))
    lev = level0[starts].copy()
    for t in range(longest):
        m = int(np.searchsorted(-lengths, -t, side="left"))  # chains longer than t
        at = starts[:m] + t
        lev[:m] = np.where(np.isnan(level0[at]), lev[:m], np.where(np.isnan(lev[:m]), level0[at], SMOOTH * lev[:m] + (1 - SMOOTH) * level0[at]))
        level[at] = lev[:m]
        lf = logf[at]
        l = np.where(np.isnan(lev[:m]), 0.0, lev[:m])[:, None]
        nb, a, b = n_bare[at][:, None], s1[at][:, None], s2[at][:, None]
        shift = np.where(np.isnan(lf), 0.0, lf) - l
        bare = -(b + 2 * a * shift + nb * shift**2) / (2 * SIGMA**2)
        emit = np.where(np.isnan(lf), -1e9, bare + AGAINST * (nb - fit[at]) + AGAINST * (hard[at].sum(1, keepdims=True) - hard[at]))
        if t == 0:
            score[:m] = emit
        else:
            prev = score[:m]
            best = prev.argmax(1)
            jump = prev[np.arange(m), best][:, None] + SWITCH
            stay = prev >= jump
            back[at] = np.where(stay, np.arange(Q.STATES), best[:, None])
            score[:m] = np.where(stay, prev, jump) + emit
    last = starts + lengths - 1
    now = score.argmax(1).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        m = int(np.searchsorted(-lengths, -t, side="left"))
        at = starts[:m] + t
        ends = at == last[:m]
        nxt = np.minimum(at + 1, n - 1)
        cur = np.where(ends, now[:m], back[nxt, state[nxt]])
        state[at] = cur
    return state, level


_STEP = "device bigint, parameter string, month int, state tinyint, level double"


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole chains from batches sorted by (device, parameter, month); a chain cut by a batch's end waits for the rest."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        key = rest["device"].fillna(-1).astype("int64").astype(str) + "|" + rest["parameter"]
        open_from = int((key != key.iloc[-1]).to_numpy().nonzero()[0].max(initial=-1)) + 1
        if open_from:
            yield _decode_chains(rest.iloc[:open_from])
            rest = rest.iloc[open_from:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield _decode_chains(rest)


def _decode_chains(df: pd.DataFrame) -> pd.DataFrame:
    df = df.reset_index(drop=True)
    key = df["device"].fillna(-1).astype("int64").astype(str) + "|" + df["parameter"]
    first = (key != key.shift()).to_numpy()
    wide = lambda p: np.column_stack([df[f"{p}{k}"].to_numpy(float) for k in range(Q.STATES)])
    logf = np.full((len(df), Q.STATES), np.nan)
    for (_,), g in df.groupby(["parameter"], sort=False):
        f = np.asarray(g["factors"].iloc[0], float)
        logf[g.index, : len(f)] = np.log(f)
    n = df["labelled"].to_numpy(float)
    level0 = np.where(n > 0, df["label_sum"].to_numpy(float) / np.maximum(n, 1), np.nan)
    state, level = _viterbi(wide("h"), df["bare"].to_numpy(float), df["s1"].to_numpy(float), df["s2"].to_numpy(float), wide("f"), level0, logf, first)
    return pd.DataFrame({"device": df["device"], "parameter": df["parameter"], "month": df["month"], "state": state, "level": level})


def unit_steps(read: DataFrame) -> DataFrame:
    """The chains' steps: (device, parameter, month, state, level), decoded."""
    lx = F.log("x")
    bare = F.col("idx").isNull()
    in_band = lambda k: (F.col("x") * F.get("factors", F.lit(k))).between(F.col("low"), F.col("high"))
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    steps = read.groupBy("device", "parameter", "month").agg(
        *[one(F.col("idx") == k).alias(f"h{k}") for k in range(Q.STATES)],
        *[one(bare & in_band(k)).alias(f"f{k}") for k in range(Q.STATES)],
        one(bare).alias("bare"),
        F.sum(F.when(bare, lx).otherwise(0.0)).alias("s1"),
        F.sum(F.when(bare, lx * lx).otherwise(0.0)).alias("s2"),
        one(~bare & F.col("home").between(F.col("low"), F.col("high"))).alias("labelled"),
        F.sum(F.when(~bare & F.col("home").between(F.col("low"), F.col("high")), F.log("home")).otherwise(0.0)).alias("label_sum"),
        F.first("factors").alias("factors"),
    )
    n = steps.repartition("device", "parameter").sortWithinPartitions("device", "parameter", "month")
    return n.mapInPandas(_decode, _STEP)


def normalize_units(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every record's quantity in its parameter's common unit.

    records: (record_kind, record_id, device, parameter, value, unit, hint, ts), see
    :func:`spec_records` and :func:`point_records`; further columns are ignored. Returns
    (record_kind, record_id, device, parameter, number, unit, common_unit, value_common,
    decoded, is_common): unit is the stated or decoded unit, decoded tells which; is_common
    is false where number or scale isn't the common unit's. Records of parameters without
    common unit, and missing or unreadable values, come out with null number, unit,
    value_common, decoded and is_common. Null devices form a chain of their
    own, records without a time a step of their own. An empty table gives an empty result.
    """
    month = F.coalesce(F.year("ts") * 12 + F.month("ts"), F.lit(0)).cast("int").alias("month")
    read = read_records(records.select("record_kind", "record_id", "device", "parameter", "value", "unit", "hint", month), catalog)
    narrow = materialize(read.drop("value", "unit", "missing", "alone"), "units")
    known = narrow.join(F.broadcast(common_units(catalog).drop("dim", "common")), "parameter", "left")
    # a nought is a stand-in unless it was rounded in a larger unit or scale ("0.00 million kV")
    rounded = (F.col("number") == 0) & F.col("idx").isNotNull() & ((F.col("idx") != 0) | (F.col("scale") != 1))
    readable = F.coalesce(((F.col("number") > 0) | rounded) & F.col("states").isNotNull(), F.lit(False))
    full = known.where(readable).withColumn("x", F.col("number") * F.col("scale"))
    steps = unit_steps(full.select("device", "parameter", "month", "idx", "x", "home", "low", "high", "factors"))
    unit_of = lambda i: F.get("states", i.cast("int"))
    sure = full.where(F.col("idx").isNotNull()).select(
        "record_kind", "record_id", "device", "parameter", "number", unit_of(F.col("idx")).alias("unit"), F.get("states", F.lit(0)).alias("common_unit"), F.col("home").alias("value_common"),
        F.lit(False).alias("decoded"), ((F.col("idx") == 0) & (F.col("scale") == 1)).alias("is_common"),
    )
    open_ = full.where(F.col("idx").isNull())
    on = [open_["device"].eqNullSafe(steps["device"]), open_["parameter"] == steps["parameter"], open_["month"] == steps["month"]]
    joined = open_.join(steps.select("device", "parameter", "month", "state", "level"), on, "left").select(
        "record_kind", "record_id", open_["device"], open_["parameter"], "number", "x", "states", "factors", "low", "high", "state", "level", "hint_idx",
    )
    # the most probable unit: the record's own emission, its month's state, the unit it once had
    score = lambda f, i: (
        -F.coalesce((F.log(F.col("x") * f) - F.col("level")) ** 2, F.lit(0.0)) / (2 * SIGMA**2)
        + F.when((F.col("x") * f).between(F.col("low"), F.col("high")), 0.0).otherwise(2 * AGAINST)
        + F.when(F.col("state") == i, 0.0).otherwise(SWITCH)
        + F.when(F.coalesce(F.col("hint_idx"), i) == i, 0.0).otherwise(2 * AGAINST)
    )
    scored = F.transform("factors", lambda f, i: F.struct(F.when((i == 0) | F.isnan(f), F.lit(-1e9)).otherwise(score(f, i)).alias("s"), (-i).alias("i")))
    joined = joined.withColumn("_b", F.array_max(scored)).withColumn("_i", (-F.col("_b.i")).cast("int"))
    value = F.when(unit_of(F.col("_i")) == "deg", F.tan(F.radians("x")) * 100).otherwise(F.col("x") * F.get("factors", F.col("_i")))
    decoded = joined.select(
        "record_kind", "record_id", "device", "parameter", "number", unit_of(F.col("_i")).alias("unit"), F.get("states", F.lit(0)).alias("common_unit"), value.alias("value_common"), F.lit(True).alias("decoded"), F.lit(False).alias("is_common"),
    )
    none = lambda kind: F.lit(None).cast(kind)
    unread = known.where(~readable).select(
        "record_kind", "record_id", "device", "parameter", none("double").alias("number"), none("string").alias("unit"), F.get("states", F.lit(0)).alias("common_unit"), none("double").alias("value_common"), none("boolean").alias("decoded"), none("boolean").alias("is_common"),
    )
    return sure.unionByName(decoded).unionByName(unread)


def not_common(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """(record_kind, record_id) of the quantities that aren't in the common unit and scale."""
    return normalize_units(records, catalog).where(~F.col("is_common")).select("record_kind", "record_id")

"""One surviving record per group of duplicates, by skyline selection.

Records of a group first agree or disagree on their value; the largest set of agreeing
records stands for the group. A lexicographic policy picks its survivor. The records of the
set are peeled into layers of the skyline over completeness (fields that have a value),
trust and recency: the first layer is dominated by no other record, the second only by the
first, and so on. The survivor's empty fields are filled from the successive layers, within
a layer by the policy.

Nothing gathers a group. Values are counted before the shuffle, sets of agreeing values are
found in cells as wide as the tolerance. A group's records, sorted, pass by once; a record's
layer follows from the highest recency so far in each layer, so what is kept of a group is
its layers' edges, its best record and its best value of each field. A record below a
complete one can fill nothing and is dropped, first within salted parts of a large group.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.units import read_records
from ..session import materialize

#: Records of a group beyond which it is thinned out first, in parts of about that size.
PART = 50_000
FIELDS = ("unit", "confidence", "source_url", "extracted_at")
GROUP = ["run_id", "equipment_id", "parameter"]
_SCALE = 1_000_000_000


def keyed(candidates: DataFrame, catalog: DataFrame, mixed: bool = False) -> DataFrame:
    """Candidates with text (a text value's key) or num (a value in the common unit); both are null where the value is missing."""
    plain = candidates.select(
        *[F.col(c) for c in (*GROUP, "candidate_id", "unit", "value", "source_url")],
        F.col("confidence").cast("double").alias("confidence"),
        F.col("extracted_at"),
        F.lit(None).cast("string").alias("hint"),
    )
    read = read_records(plain, catalog, bare_is_common=True, mixed=mixed)
    num = F.when(~F.col("missing"), F.coalesce("home", F.when(F.col("alone") & F.col("idx").isNull(), F.col("number"))))
    return (
        read.withColumn("num", F.when(num > 0, num))
        .withColumn("text", F.when(~F.col("missing") & F.col("num").isNull(), F.lower(F.regexp_replace(F.col("value"), r"(?U)^\s+|\s+$", ""))))
        .select(*plain.columns[:-1], "num", "text")
    )


def _policy() -> Column:
    """Greater is better: a source, then confidence, then a later time, then a smaller id."""
    url = (F.trim(F.coalesce("source_url", F.lit(""))) != "").cast("int")
    return F.struct(url.alias("has"), F.coalesce(F.when(~F.isnan("confidence"), F.col("confidence")), F.lit(-1.0)).alias("trust"), F.coalesce(F.unix_micros("extracted_at"), F.lit(-(2**62))).alias("recent"), (-F.col("candidate_id")).alias("order"))


def agreed(rows: DataFrame, tolerance: float) -> DataFrame:
    """Per group of two or more records, its largest set of agreeing values: (group, lo, hi) or (group, text); of sets equally large the one with the best record."""
    span = round(math.log1p(tolerance) * _SCALE)
    values = rows.groupBy(*GROUP, "num", "text").agg(F.count("*").alias("n"), F.max(_policy()).alias("best"))
    sized = values.groupBy(*GROUP).agg(F.sum("n").alias("rows"))
    values = values.where(F.col("num").isNotNull() | F.col("text").isNotNull())
    texts = values.where(F.col("text").isNotNull()).select(*GROUP, F.struct("n", "best", F.lit(None).cast("bigint").alias("lo"), "text").alias("set"))
    log = F.round(F.log("num") * _SCALE).cast("bigint")
    cells = values.where(F.col("num").isNotNull()).withColumn("log", log).withColumn("cell", F.floor(F.col("log") / span)).withColumn("at", F.explode(F.array("cell", F.col("cell") - 1)))
    near = Window.partitionBy(*GROUP, "at").orderBy("log").rangeBetween(0, span + 2)
    nums = (
        cells.select(*GROUP, "at", "cell", "log", F.sum("n").over(near).alias("n"), F.max("best").over(near).alias("best"))
        .where(F.col("at") == F.col("cell"))
        .select(*GROUP, F.struct("n", "best", F.col("log").alias("lo"), F.lit(None).cast("string").alias("text")).alias("set"))
    )
    chosen = nums.unionByName(texts).groupBy(*GROUP).agg(F.max("set").alias("set"))
    on = [chosen[c].eqNullSafe(sized[c]) for c in GROUP]
    return chosen.join(sized.where("rows > 1"), on, "left_semi").select(*GROUP, F.col("set.lo").alias("lo"), (F.col("set.lo") + span + 2).alias("hi"), F.col("set.text").alias("of"), F.col("set.n").alias("support"))


class Skyline:
    """Layers of points that come by trust, then recency, then completeness, the greater first: only earlier points can dominate later ones.

    Per completeness the negated highest recency of every layer among the points at least as
    complete; it only rises from layer to layer, so a point's layer is found by bisection.
    """

    def __init__(self, levels: int = len(FIELDS) + 1):
        self.levels = levels
        self.start()

    def start(self) -> None:
        self.layers: list[list[int]] = [[] for _ in range(self.levels)]

    def __call__(self, recent: int, complete: int) -> int:
        layer = bisect.bisect_right(self.layers[complete], -recent)
        for c in range(complete + 1):
            have = self.layers[c]
            if layer < len(have):
                have[layer] = min(have[layer], -recent)
            else:
                have.append(-recent)
        return layer + 1


_REST = ["candidate_id", "value", *FIELDS]
_FOLDED = "support bigint, candidate_id bigint, value string, unit string, confidence double, source_url string, extracted_at timestamp, filled array<string>, layers int"


class _Group:
    """What is kept of a group while its sorted records pass by."""

    def __init__(self, first: tuple):
        self.first, self.sky, self.below, self.point, self.layer, self.layers = first, Skyline(), None, None, 0, 0
        self.top, self.fills = None, [None] * len(FIELDS)

    def add(self, policy: tuple, complete: int, record: tuple) -> bool:
        """Whether the record can fill fields; a point below a complete one can't."""
        if self.top is None or policy > self.top[0]:
            self.top = (policy, record)
        _, trust, recent, _ = policy
        point = (trust, recent, complete)
        if point != self.point:
            if self.below is not None and recent <= self.below:
                return False
            if complete == len(FIELDS):
                self.below = recent
            self.point, self.layer = point, self.sky(recent, complete)
            self.layers = max(self.layers, self.layer)
        rank = (-self.layer, policy)
        for i, v in enumerate(record[2:]):
            if v is not None and (self.fills[i] is None or rank > self.fills[i][0]):
                self.fills[i] = (rank, v)
        return True

    def result(self) -> tuple:
        fields = list(self.top[1][2:])
        filled = [f for f, v, o in zip(FIELDS, fields, self.fills) if v is None and o is not None]
        fields = [v if v is not None or o is None else o[1] for v, o in zip(fields, self.fills)]
        return (*self.first, *self.top[1][:2], *fields, filled, self.layers)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple]]]:
    for b in batches:
        column = lambda c: b.column(b.schema.get_field_index(c)).to_pylist()
        policy = zip(*(column(c) for c in ("has", "trust", "recent", "order")))
        yield b, zip(column("_g"), policy, column("complete"), zip(*(column(c) for c in _REST)))


def _folded(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted records to one row a group."""
    group, key, types = None, None, []
    columns = [*names, *_REST, "filled", "layers"]
    make = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=columns)
    for b, records in _records(batches):
        types = types or [*(b.schema.field(c).type for c in (*names, *_REST)), pa.list_(pa.string()), pa.int32()]
        out, firsts = [], list(zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in names)))
        for i, (g, policy, complete, record) in enumerate(records):
            if group is None or g != key:
                if group is not None:
                    out.append(group.result())
                group, key = _Group(firsts[i]), g
            group.add(policy, complete, record)
        yield make(out)
    if group is not None:
        yield make([group.result()])


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted records without those that a complete one dominates; a group's best by the policy stays."""
    group, key, held = None, None, None
    for b, records in _records(batches):
        keep = []
        before = None
        for i, (g, policy, complete, record) in enumerate(records):
            if group is None or g != key:
                if held is not None:
                    if isinstance(held, int):
                        keep.append(held)
                    else:
                        before = held
                group, key, held = _Group(()), g, None
            best = group.top is None or policy > group.top[0]
            if group.add(policy, complete, record):
                keep.append(i)
                held = None if best else held
            elif best:
                held = i
        if before is not None:
            yield before
        yield b.take(pa.array(sorted(keep), pa.int32()))
        if isinstance(held, int):
            held = b.slice(held, 1)
    if held is not None:
        yield held


def _sorted(records: DataFrame, keys: list[str]) -> DataFrame:
    df = records.withColumn("_g", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    return df.repartition(*keys).sortWithinPartitions("_g", F.desc("trust"), F.desc("recent"), F.desc("complete"))


def survivors(candidates: DataFrame, catalog: DataFrame, tolerance: float = 0.02, mixed: bool = False) -> DataFrame:
    """One record per (run_id, equipment_id, parameter) of two or more records.

    Numbers agree within ``tolerance`` in one unit (no unit means the common one), texts if
    equal but for case and outer blanks; mixed: numbers come in several styles, so that a
    comma before three digits may be a decimal one. Returns the group with candidate_id and
    best_value of the survivor, its unit, confidence, source_url and extracted_at (each filled
    from the layers where empty), filled (names of the filled fields), support (records that
    agree) and layers (of the records that no complete one dominates). Null keys are a group
    of their own. Groups whose values are all missing, and an empty table, give no rows.
    Equal records: the smallest candidate_id. Other columns, whatever their names, are ignored.
    """
    rows = materialize(keyed(candidates, catalog, mixed), "candidates")  # read once, used three times
    chosen = materialize(agreed(rows, tolerance), "sets")
    r, c = rows.alias("r"), chosen.alias("c")
    log = F.round(F.log("r.num") * _SCALE).cast("bigint")
    on = [F.col(f"r.{g}").eqNullSafe(F.col(f"c.{g}")) for g in GROUP]
    in_set = F.when(F.col("c.of").isNotNull(), F.col("r.text") == F.col("c.of")).otherwise(log.between(F.col("c.lo"), F.col("c.hi")))
    members = r.join(c, on).where(in_set).select("r.*", "c.support")
    blank = lambda x: F.when(F.trim(x) != "", x)
    record = members.select(*GROUP, F.col("support").cast("bigint").alias("support"), _policy().alias("p"), "candidate_id", "value", blank(F.col("unit")).alias("unit"), F.when(~F.isnan("confidence"), F.col("confidence")).alias("confidence"), blank(F.col("source_url")).alias("source_url"), F.col("extracted_at").cast("timestamp").alias("extracted_at"))
    complete = sum((F.col(f).isNotNull().cast("int") for f in FIELDS), F.lit(0))
    record = record.select(*GROUP, "support", "p.*", *_REST, complete.alias("complete"))
    if chosen.where(F.col("support") > PART).limit(1).count():  # large groups are thinned out in parts before they meet
        part = F.pmod(F.xxhash64("candidate_id"), F.ceil(F.col("support") / PART)).cast("int").alias("part")
        thin = _sorted(record.where(F.col("support") > PART).withColumn("part", part), [*GROUP, "part"])
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in thin.schema)
        record = record.where(F.col("support") <= PART).unionByName(thin.mapInArrow(_thinned, schema).drop("part", "_g"))
    groups = [f"{f.name} {f.dataType.simpleString()}" for f in record.select(*GROUP).schema]
    schema = ", ".join([*groups, _FOLDED])
    folded = _sorted(record, GROUP).mapInArrow(lambda it: _folded(it, [*GROUP, "support"]), schema)
    return folded.select(*GROUP, "candidate_id", F.col("value").alias("best_value"), *FIELDS, "filled", "support", "layers")

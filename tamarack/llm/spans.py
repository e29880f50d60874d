"""Long spans that stand verbatim in more than one document.

1. Texts are cut where lines and sentences end. A unit begins at each such place and goes on
   over whole lines and sentences until it has ``SHORT`` characters; its digest is grouped
   over all documents. What stretches of ``least`` characters hold no whole unit (long
   sentences, tables without line ends, signs in a row) is covered by runs of ``least // 2``
   characters picked by content: of the runs in every such stretch the one with the
   smallest hash. Whether a stretch holds a unit is told by its own characters alone, so two
   documents that share one have the same unit or the same run in it, and none is missed.
2. Digests are counted first; only units that occur twice get their surroundings, and equal
   surroundings are merged before any two are compared. Where a digest has more than
   ``CLASSES`` different surroundings (a licence's sentence) they aren't compared in pairs:
   the stretches of ``least`` characters around each are grouped, which is linear in them.
   Compared are strings, so a collision of digests can't make a span.
3. Of each span the occurrence in the document of the smallest id is kept and the later ones
   can be removed, with their original offsets (:func:`without_repeats`).

Exact copies count once (membership is joined in at the end). All links and spans are within
``least`` characters of a unit, and every part of a longer span is near one of its own
units; their union is the whole span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Characters of a unit at least, and different surroundings of a digest that are compared in pairs.
SHORT, CLASSES = 40, 64
#: Characters hashed at a time: bounds a worker's memory, not the length of a text.
AT_ONCE = 1 << 20
# Stops that a blank follows at a sentence's end, and those that end it themselves.
_STOPS, _FULL_STOPS = [ord(c) for c in ".!?;:"], [ord(c) for c in "。！？；：…"]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOW = np.uint64((1 << 20) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(codes: np.ndarray, unit: int) -> np.ndarray:
    """A hash of each run of ``unit`` characters."""
    n = len(codes)
    if n < unit:
        return np.zeros(0, np.uint64)
    powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n - 1, _BASE, np.uint64))))
    back = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n - unit, _INVERSE, np.uint64))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(0x5DEECE66D)) * powers, dtype=np.uint64)))
    return _mix((sums[unit:] - sums[:-unit]) * back)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for each i."""
    n = len(x) - width + 1
    pad = (-len(x)) % width
    blocks = np.concatenate((x, np.full(pad, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def picked(codes: np.ndarray, unit: int, least: int, bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the picked units of one text, which has ``least`` characters or more; bare: the places whose stretch needs one."""
    found_at, found_h = [], []
    width = least - unit + 1
    for lo in range(0, len(codes) - least + 1, AT_ONCE):  # slices overlap by a stretch
        w = np.flatnonzero(bare[lo : lo + AT_ONCE])
        if not len(w):
            continue
        first, last = int(w[0]), int(w[-1])
        h = run_hashes(codes[lo + first : lo + last + least], unit)
        i = np.arange(len(h), dtype=np.uint64)
        m = _sliding_min((h & ~_LOW) | i & _LOW, width)[w - first]
        new = np.concatenate(([True], m[1:] != m[:-1]))
        w = w[new] - first
        at = w + ((m[new] - w.astype(np.uint64)) & _LOW).astype(np.int64)
        found_at.append(at + lo + first)
        found_h.append(h[at])
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, h = np.concatenate(found_at), np.concatenate(found_h)
    at, first = np.unique(at, return_index=True)
    h = h[first]
    # of overlapping runs with one hash (a repeated pattern) the first, the last and one within each reach are enough
    same = np.concatenate(([False], (h[1:] == h[:-1]) & (np.diff(at) < unit)))
    chain = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
    step = (at - at[chain]) // max(1, (least - unit) // 2)
    inner = same & np.concatenate((same[1:], [False])) & np.concatenate(([False], step[1:] == step[:-1]))
    return at[~inner], h[~inner]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def boundaries(codes: np.ndarray) -> np.ndarray:
    """Places where a line or sentence begins, each told by the two characters before it."""
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    last, before = codes[1:-1], codes[:-2]
    ends = last == 10
    for c in _FULL_STOPS:
        ends |= last == c
    stop = before == _STOPS[0]
    for c in _STOPS[1:]:
        stop |= before == c
    ends |= stop & (last == 32)
    return np.flatnonzero(ends) + 2


def line_units(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the units made of whole lines and sentences, none longer than fits in every stretch that it stands in."""
    at = boundaries(codes)
    short = max(1, min(SHORT, least // 5))
    end = np.searchsorted(at, at + short)
    ok = end < len(at)
    start, end = at[ok], at[end[ok]]
    ok = end - start <= least - short
    return start[ok], end[ok]


def bare_places(start: np.ndarray, end: np.ndarray, n: int, least: int) -> np.ndarray:
    """For each place whether the stretch of ``least`` characters from it holds no whole unit (with the two characters before it)."""
    held = np.zeros(max(0, n - least + 1) + 1, np.int64)
    lo, hi = np.maximum(end - least, 0), np.minimum(start - 2, n - least)
    ok = lo <= hi
    np.add.at(held, lo[ok], 1)
    np.add.at(held, hi[ok] + 1, -1)
    return np.cumsum(held[:-1]) == 0


def text_units(text: str, least: int, lines: bool = True, runs: bool = True) -> tuple[list[int], list[int], list[int]]:
    """(digest, place, length) of the units of a text; lines=False and runs=False leave one kind out."""
    codes = _codes(text)
    unit = max(1, least // 2)
    start, end = line_units(codes, least) if lines else (np.zeros(0, np.int64),) * 2
    ats, sizes = start.tolist(), (end - start).tolist()
    digests = [xxhash.xxh64_intdigest(text[a : a + k].encode("utf-8", "surrogatepass")) - (1 << 63) for a, k in zip(ats, sizes)]
    if not runs:
        return digests, ats, sizes
    at, h = picked(codes, unit, least, bare_places(start, end, len(codes), least))
    return digests + h.view(np.int64).tolist(), ats + at.tolist(), sizes + [unit] * len(at)


def _units(batches: Iterator[pa.RecordBatch], least: int, kinds: tuple[bool, bool]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docs, texts = b.column(0), b.column(1).to_pylist()
        found = [text_units(t, least, *kinds) for t in texts]
        rows = np.repeat(np.arange(len(texts)), [len(f[0]) for f in found])
        flat = lambda k, t: pa.array([x for f in found for x in f[k]], t)
        yield pa.RecordBatch.from_arrays([flat(0, pa.int64()), docs.take(pa.array(rows)), flat(1, pa.int32()), flat(2, pa.int32())], names=["digest", "doc_id", "at", "size"])


def _around(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The text around each unit, as far as a stretch of ``least`` characters that holds it can reach."""
    for b in batches:
        digest, doc, at, size, off, ctx = [], [], [], [], [], []
        for d, t, units in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            for u in units:
                p, k = u["at"], u["size"]
                digest.append(u["digest"])
                doc.append(d)
                at.append(p)
                size.append(k)
                off.append(min(p, least - k))
                ctx.append(t[max(0, p - least + k) : p + least])
        yield pa.RecordBatch.from_arrays([pa.array(digest, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int32()), pa.array(size, pa.int32()), pa.array(off, pa.int32()), pa.array(ctx, pa.string())], names=["digest", "doc_id", "at", "size", "off", "ctx"])


def _common(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """How far two surroundings agree before and after the unit's start; pairs that share less than ``least`` characters fall out."""

    def aligned(ctx, off, fill: str) -> np.ndarray:
        text = "".join([(fill * (least - o) + c).ljust(2 * least, fill) for c, o in zip(ctx, off)])
        return _codes(text).reshape(-1, 2 * least)

    for b in batches:
        if not len(b):
            continue
        # the fillers aren't characters of any text, and differ
        same = aligned(b["ctx_a"], b["off_a"], chr(0x10FFFE)) == aligned(b["ctx_b"], b["off_b"], chr(0x10FFFF))
        stop = np.ones((len(b), 1), bool)
        right = np.argmax(np.concatenate((~same[:, least:], stop), axis=1), axis=1)  # the unit and what follows
        left = np.argmax(np.concatenate((~same[:, least - 1 :: -1], stop), axis=1), axis=1)
        ok = (right >= b["size"]) & (left + right >= least)
        yield pd.DataFrame({"digest": b["digest"][ok], "class_a": b["class_a"][ok], "class_b": b["class_b"][ok], "left": left[ok].astype("int32"), "right": right[ok].astype("int32")})


def _stretches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Every stretch of ``least`` characters of each surroundings, as a digest of 128 bits, with its start relative to the unit's."""
    for b in batches:
        digest, cls, start, key = [], [], [], []
        for d, c, o, ctx in zip(*(b.column(i).to_pylist() for i in range(4))):
            for i in range(len(ctx) - least + 1):
                digest.append(d)
                cls.append(c)
                start.append(i - o)
                key.append(xxhash.xxh128_digest(ctx[i : i + least].encode("utf-8", "surrogatepass")))
        yield pa.RecordBatch.from_arrays([pa.array(digest, pa.int64()), pa.array(cls, pa.int64()), pa.array(start, pa.int32()), pa.array(key, pa.binary())], names=["digest", "class", "start", "key"])


class Shared:
    """The parts that links and spans are made of."""

    def __init__(self, documents: DataFrame, least: int = 200, lines: bool = True, runs: bool = True):
        self.least = least
        docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.length("text") >= least)
        self.sizes = docs.select("doc_id", F.length("text").alias("chars"))
        keyed = docs.select("doc_id", F.sha2("text", 256).alias("sha"))
        first = keyed.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
        #: (doc_id, first) of the documents that have exact copies
        self.copies = materialize(keyed.join(first, "sha").select("doc_id", "first").distinct(), "copies")
        texts = docs.join(self.copies.where("doc_id != first"), "doc_id", "left_anti")
        units = materialize(texts.mapInArrow(lambda it: _units(it, least, (lines, runs)), "digest bigint, doc_id bigint, at int, size int"), "units")
        again = units.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
        lists = units.join(again, "digest", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("digest", "at", "size")).alias("units"))
        around = texts.join(lists, "doc_id").select("doc_id", "text", "units").mapInArrow(lambda it: _around(it, least), "digest bigint, doc_id bigint, at int, size int, off int, ctx string")
        around = materialize(around.withColumn("class", F.xxhash64("off", "ctx")), "around")
        #: (digest, class, doc_id, at): equal surroundings have one class
        self.members = around.select("digest", "class", "doc_id", "at")
        classes = around.groupBy("digest", "class").agg(F.first("size").alias("size"), F.first("off").alias("off"), F.first("ctx").alias("ctx"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        classes = materialize(classes, "classes")
        many = classes.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > CLASSES).select("digest")
        few = classes.join(many, "digest", "left_anti")
        a, b = few.alias("a"), few.alias("b")
        on = (F.col("a.digest") == F.col("b.digest")) & (F.col("a.class") < F.col("b.class")) & ~((F.col("a.lo") == F.col("a.hi")) & (F.col("b.lo") == F.col("b.hi")) & (F.col("a.lo") == F.col("b.lo")))
        pairs = a.join(b, on).select("a.digest", F.least("a.size", "b.size").alias("size"), F.col("a.class").alias("class_a"), F.col("b.class").alias("class_b"), F.col("a.off").alias("off_a"), F.col("b.off").alias("off_b"), F.col("a.ctx").alias("ctx_a"), F.col("b.ctx").alias("ctx_b"))
        linked = pairs.mapInPandas(lambda it: _common(it, least), "digest bigint, class_a bigint, class_b bigint, left int, right int")
        own = classes.where((F.col("lo") < F.col("hi")) & (F.length("ctx") >= least)).select("digest", F.col("class").alias("class_a"), F.col("class").alias("class_b"), F.col("off").alias("left"), (F.length("ctx") - F.col("off")).alias("right"))
        #: (digest, class_a, class_b, left, right): classes whose members share left + right characters around the unit's start
        self.linked = materialize(linked.unionByName(own), "linked")
        crowd = classes.join(many, "digest", "left_semi").select("digest", "class", "off", "ctx")
        stretches = crowd.mapInArrow(lambda it: _stretches(it, least), "digest bigint, class bigint, start int, key binary")
        #: (key, doc_id, place) of the stretches in crowded surroundings, where another document has the stretch too
        places = stretches.join(self.members, ["digest", "class"]).select("key", "doc_id", (F.col("at") + F.col("start")).alias("place")).distinct()
        places = materialize(places, "places")
        shared = places.groupBy("key").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest")).where("lowest < highest")
        self.places = places.join(shared, "key")

    def pairs(self) -> DataFrame:
        """(doc_id_a, doc_id_b), smaller first, of documents that share a span; copies are expanded."""
        m = self.members.select("digest", "class", "doc_id").distinct()
        a, b, k = m.alias("a"), m.alias("b"), self.linked.alias("k")
        half = k.join(a, (F.col("k.digest") == F.col("a.digest")) & (F.col("k.class_a") == F.col("a.class"))).select("k.digest", "k.class_b", F.col("a.doc_id").alias("x"), (F.col("k.class_a") == F.col("k.class_b")).alias("own"))
        both = half.alias("h").join(b, (F.col("h.digest") == F.col("b.digest")) & (F.col("h.class_b") == F.col("b.class"))).where((F.col("x") < F.col("b.doc_id")) | (~F.col("own") & (F.col("x") != F.col("b.doc_id"))))
        links = both.select(F.least("x", "b.doc_id").alias("doc_id_a"), F.greatest("x", "b.doc_id").alias("doc_id_b"))
        p = self.places.select("key", "doc_id").distinct()
        crowd = p.alias("p").join(p.alias("q"), (F.col("p.key") == F.col("q.key")) & (F.col("p.doc_id") < F.col("q.doc_id"))).select(F.col("p.doc_id").alias("doc_id_a"), F.col("q.doc_id").alias("doc_id_b"))
        links = links.unionByName(crowd).distinct()
        c = self.copies
        ca, cb = c.select(F.col("first").alias("doc_id_a"), F.col("doc_id").alias("x")), c.select(F.col("first").alias("doc_id_b"), F.col("doc_id").alias("y"))
        spread = links.join(ca, "doc_id_a", "left").join(cb, "doc_id_b", "left").select(F.coalesce("x", "doc_id_a").alias("x"), F.coalesce("y", "doc_id_b").alias("y"))
        within = c.alias("p").join(c.alias("q"), (F.col("p.first") == F.col("q.first")) & (F.col("p.doc_id") < F.col("q.doc_id"))).select(F.col("p.doc_id").alias("x"), F.col("q.doc_id").alias("y"))
        return spread.unionByName(within).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))

    def _hits(self) -> DataFrame:
        """(doc_id, start, end, earlier) of what is shared around each unit of the first of equal documents."""
        sides = self.linked.select("digest", F.col("class_a").alias("class"), F.col("class_b").alias("other"), "left", "right").unionByName(
            self.linked.where("class_a != class_b").select("digest", F.col("class_b").alias("class"), F.col("class_a").alias("other"), "left", "right")
        )
        least_of = self.members.groupBy("digest", "class").agg(F.min("doc_id").alias("lowest"))
        far = sides.join(least_of.withColumnRenamed("class", "other"), ["digest", "other"]).groupBy("digest", "class", "left", "right").agg(F.min("lowest").alias("lowest"))
        hits = self.members.join(far, ["digest", "class"]).select("doc_id", (F.col("at") - F.col("left")).alias("start"), (F.col("at") + F.col("right")).alias("end"), (F.col("lowest") < F.col("doc_id")).alias("earlier"))
        return hits.unionByName(self.places.select("doc_id", F.col("place").alias("start"), (F.col("place") + self.least).alias("end"), (F.col("lowest") < F.col("doc_id")).alias("earlier")))

    def spans(self, later_only: bool = False) -> DataFrame:
        """(doc_id, start, length, earlier): the maximal shared stretches of each document; earlier tells whether some of it stands in a document of a smaller id. later_only: the stretches that do."""
        hits = self._hits()
        hits = hits.where("earlier") if later_only else hits
        # stretches that touch are one: a new one begins beyond the end of all before it
        before = Window.partitionBy("doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
        along = Window.partitionBy("doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
        marked = hits.groupBy("doc_id", "start", "end").agg(F.max("earlier").alias("earlier")).withColumn("new", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
        merged = marked.withColumn("no", F.sum("new").over(along)).groupBy("doc_id", "no").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"), F.max("earlier").alias("earlier")).drop("no")
        c = self.copies.join(self.sizes.distinct(), "doc_id")
        c = c.where("doc_id != first") if later_only else c
        whole = c.select("doc_id", F.lit(0).alias("start"), F.col("chars").alias("length"), (F.col("doc_id") != F.col("first")).alias("earlier"))
        copies = self.copies.where("doc_id != first") if later_only else self.copies
        return merged.join(copies, "doc_id", "left_anti").unionByName(whole)


def shared_pairs(documents: DataFrame, least: int = 200) -> DataFrame:
    """Pairs (doc_id_a, doc_id_b) of documents(doc_id, text) that share a verbatim span of ``least`` or more code points.

    Null, empty and shorter texts share nothing. Equal texts of different ids are pairs. An
    empty table gives an empty result; other columns are ignored; ids must be unique.
    """
    return Shared(documents, least).pairs()


def shared_spans(documents: DataFrame, least: int = 200) -> DataFrame:
    """(doc_id, start, length, earlier) of each shared span, see :meth:`Shared.spans`."""
    return Shared(documents, least).spans()


def shared_portion(documents: DataFrame, least: int = 200) -> DataFrame:
    """Per document with text: spans (array of start, length), shared_chars and the portion of the text they cover; zeros where nothing is shared, and for null and empty texts."""
    spans = shared_spans(documents, least).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"), F.sum("length").alias("shared_chars"))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    none = F.array().cast("array<struct<start:int,length:int>>")
    return docs.join(spans, "doc_id", "left").select("doc_id", "chars", F.coalesce("spans", none).alias("spans"), F.coalesce("shared_chars", F.lit(0)).cast("bigint").alias("shared_chars"), F.when(F.col("chars") > 0, F.coalesce("shared_chars", F.lit(0)) / F.col("chars")).otherwise(0.0).alias("portion"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            if t is not None and spans:
                at, kept = 0, []
                for s in spans:
                    kept.append(t[at : s["start"]])
                    at = s["start"] + s["length"]
                t = "".join([*kept, t[at:]])
            out.append(t)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), b.column(2)], names=["doc_id", "text", "removed"])


def without_repeats(documents: DataFrame, least: int = 200) -> DataFrame:
    """(doc_id, text, removed): texts without the spans that a document of a smaller id has too; removed holds their start and length in the original text.

    The earliest occurrence stays whole; of equal documents the first. Null and empty texts stay as they are.
    """
    later = Shared(documents, least).spans(later_only=True).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("removed"))
    none = F.array().cast("array<struct<start:int,length:int>>")
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(later, "doc_id", "left").select("doc_id", "text", F.coalesce("removed", none).alias("removed"))
    return docs.mapInArrow(_without, "doc_id bigint, text string, removed array<struct<start:int,length:int>>")

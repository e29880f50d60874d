"""Template residue and error-page text: detection and exclusion.

1. Pages are read once where they lie (see :mod:`.boilerplate`). Every line becomes a shape:
   its tokens, those that hold digits masked. Shapes that stand in bodies are counted over
   all pages, and so is how often such a line is nearly all that a page has.
2. Message templates are mined from the shapes of all pages by a prefix tree of fixed depth:
   number of tokens, then the first tokens, then the most similar template of the leaf,
   whose differing tokens become wildcards. Shapes come sorted, so the templates don't
   depend on how pages lie in tasks; leaves are spread over tasks.
3. Each template is classified once. One that speaks of errors, scripts, checks, logins and
   the like is a notice if it mostly stands alone on its pages: a sentence of a manual that
   uses such words stands among others. A template that recurs and nearly always stands
   alone is a notice whatever its words. Verdicts go back to the lines by a join.
4. Separately, unfilled slots and failed values are searched inside all body lines.

A page is left out if a notice stands in place of its content, or if its body holds a slot, a
failed value, a program's message or filler text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import boilerplate as B
from .patterns import FILLER, FILLER_ANYWHERE, LATIN_FILLER, MAYBE_SLOT, MESSAGE, SLOT, TOPIC, WORDS

#: Tokens on the tree's path, and the share of tokens in which a line must be like a template.
DEPTH, ALIKE = 3, 0.6
#: Characters of text but the title on a page whose lines stand alone, and of other text on a page that a notice stands for.
ALONE = 400
#: Share of its lines that must stand alone for a template on a notice's topic, and for one on any topic, which must also recur so often.
TOPICAL, ANY, RECURS = 0.5, 0.9, 5




_DIGITS = frozenset("0123456789")
_MARKS = str.maketrans(".,;:!?()", "        ")
#: Rows of judged shapes that may be sent to every task.
BROADCAST = 50_000


def shape(line: str) -> str:
    """A line's tokens, those with digits masked."""
    tokens = line.split()
    return " ".join(tokens if _DIGITS.isdisjoint(line) else [t if _DIGITS.isdisjoint(t) else "*" for t in tokens])


def slots(line: str) -> list[str]:
    """The unfilled slots and failed values in a line."""
    return [m.group() for m in SLOT.finditer(line)] if MAYBE_SLOT.search(line) else []


def is_latin_filler(line: str) -> bool:
    low = line.lower()
    if LATIN_FILLER.isdisjoint(low.translate(_MARKS).split()):
        return False
    words = WORDS.findall(low)
    return len(words) >= 5 and sum(w in LATIN_FILLER for w in words) >= 0.8 * len(words)


def listed(template: str) -> str:
    """The verdict on a template from what it says alone: message, filler or ""."""
    low = template.lower()
    if MESSAGE.match(low):
        return "message"
    if FILLER.match(low) or (("lorem" in low or "dummy" in low) and FILLER_ANYWHERE.search(low)) or is_latin_filler(low):
        return "filler"
    return ""


def classify(template: str, lines: int, alone: int, content: int) -> str:
    """The verdict on a template: message, filler, notice or "". content: its lines that read as values, list items, headings or titles."""
    if found := listed(template):
        return found
    if alone >= TOPICAL * lines and TOPIC.search(template.lower()):
        return "notice"
    return "notice" if lines >= RECURS and alone >= ANY * lines and not content else ""


class Leaf:
    """The templates under one path of the tree, as rows of token numbers; 0 is a wildcard."""

    def __init__(self):
        self.words: dict[str, int] = {"*": 0}
        self.names = ["*"]
        self.rows = np.zeros((4, 0), np.int32)
        self.used = 0

    def add(self, tokens: list[str]) -> int:
        """The number of the template that tokens belong to: the most similar one, which they make more general, or a new one."""
        row = np.empty(len(tokens), np.int32)
        for i, t in enumerate(tokens):
            n = self.words.get(t)
            if n is None:
                n = self.words[t] = len(self.names)
                self.names.append(t)
            row[i] = n
        if self.used:
            same = (self.rows[: self.used] == row).sum(1)
            best = int(same.argmax())
            if same[best] >= ALIKE * len(tokens):
                self.rows[best][self.rows[best] != row] = 0
                return best
        if self.used == 0:
            self.rows = np.zeros((4, len(tokens)), np.int32)
        elif self.used == len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        self.rows[self.used] = row
        self.used += 1
        return self.used - 1

    @property
    def templates(self) -> list[list[str]]:
        return [[self.names[i] for i in r] for r in self.rows[: self.used].tolist()]


def path_of(masked: str) -> int:
    """The path of a shape in the tree as a digest."""
    tokens = masked.split(" ")
    return xxhash.xxh64_intdigest(" ".join([str(len(tokens)), *tokens[:DEPTH]]).encode("utf-8", "surrogatepass")) - (1 << 63)


_EXTRA = "lengths array<int>, shapes array<bigint>, slots array<struct<at:int,slot:string>>, shape bigint, leaf bigint, masked string, listed string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page, and one per shape that is new to the task."""
    names = [*(x.split()[0] for x in B.PAGE.split(", ")), "lengths", "shapes", "slots", "shape", "leaf", "masked", "listed"]
    slot_type = pa.list_(pa.struct([("at", pa.int32()), ("slot", pa.string())]))
    read = B.Reader()
    shapes_of: dict[str, tuple[int, str | None]] = {}
    seen: set[int] = set()
    for b in B._numbered(batches):
        host, title, text = (b.column(i).to_pylist() for i in (2, 4, 5))
        cols: list[list] = [[] for _ in range(8)]
        fresh: list[tuple[int, int, str, str]] = []
        if len(shapes_of) > 50_000:
            shapes_of.clear()
        if len(seen) > 1_000_000:
            seen.clear()  # both only save work
        for h, t, x in zip(host, title, text):
            lines, n, c, f = read(x or "", t, h)
            found, digests = [], []
            for i, line in enumerate(lines):
                kept = shapes_of.get(line)
                if kept is None:
                    s = slots(line) if c[i] & (B.CONTENT | B.SENTENCE) == B.CONTENT else []  # a line with a slot reads as one that stands in
                    # a line that can't stand alone is no message; it is judged by what it says
                    said = listed(line) if len(line) > ALONE else ""
                    masked = shape(line) if len(line) <= ALONE else line if said else ""
                    d = xxhash.xxh64_intdigest(masked.encode("utf-8", "surrogatepass")) - (1 << 63) if masked else 0
                    kept = shapes_of[line] = (d, s[0] if s else None)
                    if masked and d not in seen:
                        seen.add(d)
                        fresh.append((d, path_of(masked), masked, said if len(line) > ALONE else listed(masked)))
                digests.append(kept[0])
                if kept[1] is not None:
                    found.append({"at": i, "slot": kept[1]})
            body = xxhash.xxh64_intdigest((x or "").encode("utf-8", "surrogatepass")) - (1 << 63)
            for col, v in zip(cols, (body, B.content_start(c), c, n, f, [len(y) for y in lines], digests, found)):
                col.append(v)
        types = (pa.int64(), pa.int32(), pa.list_(pa.int16()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), slot_type)
        pages, more = b.num_rows, len(fresh)
        arrays = [pa.concat_arrays([b.column(i), pa.nulls(more, b.column(i).type)]) for i in range(4)]
        arrays += [pa.concat_arrays([pa.array(v, t), pa.nulls(more, t)]) for v, t in zip(cols, types)]
        for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string())):
            arrays.append(pa.concat_arrays([pa.nulls(pages, t), pa.array([r[k] for r in fresh], t)]))
        yield pa.RecordBatch.from_arrays(arrays, names=names)


_MINED = "shape bigint, leaf bigint, number int, template string, lines bigint, alone bigint, content bigint"


def _mined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted shapes into the tree: a row per shape with its template's number, and one per template when its leaf is complete."""
    at, leaf, sums = None, Leaf(), []

    def complete() -> list[tuple]:
        return [(None, at, i, " ".join(t), *s) for i, (t, s) in enumerate(zip(leaf.templates, sums))]

    for b in batches:
        rows = []
        for d, path, masked, lines, alone, content in b.itertuples(index=False):
            if path != at:
                rows += complete()
                at, leaf, sums = path, Leaf(), []
            i = leaf.add(masked.split(" "))
            if i == len(sums):
                sums.append([0, 0, 0])
            for k, v in enumerate((lines, alone, content)):
                sums[i][k] += v
            rows.append((d, path, i, None, None, None, None))
        yield _mined_frame(rows)
    yield _mined_frame(complete())


def _mined_frame(rows: list[tuple]) -> pd.DataFrame:
    names = ("shape", "leaf", "number", "template", "lines", "alone", "content")
    return pd.DataFrame({c: pd.array([r[i] for r in rows], "Int64" if c != "template" else object) for i, c in enumerate(names)})


def _classified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        v = [classify(*x) for x in zip(b["template"], b["lines"], b["alone"], b["content"])]
        yield b.assign(verdict=v)


class Mined:
    """What is learned from pages: ``lines``, the body lines of all pages, and ``templates``, with the verdict on each."""

    def __init__(self, pages: DataFrame, near: int = B.NEAR, tree: bool = True):
        schema = f"{B.PAGE}, {_EXTRA}"
        scanned = materialize(B.addressed(pages).mapInArrow(_scan, schema), "scanned")
        self.pages = scanned.where("row is not null")
        every = B.flagged(self.pages, near, ("codes", "lengths", "shapes", "slots"))
        zipped = F.arrays_zip("codes", "lengths", "flags")
        text = F.aggregate(zipped, F.lit(0), lambda a, x: a + F.when(~x["flags"] & (x["codes"].bitwiseAND(B.TITLE) == 0), x["lengths"]).otherwise(0))
        every = every.withColumn("text", text)
        self.every = materialize(every, "bodies")
        at = self.every.select("row", "text", F.posexplode(F.arrays_zip("codes", "lengths", "shapes", "flags")).alias("at", "x")).where("not x.flags")
        code = F.col("x.codes")
        title = code.bitwiseAND(B.TITLE) != 0
        #: (row, at, shape, length, text, alone, content) of each body line; a title has no length, since it counts for nothing
        self.lines = at.select("row", "at", F.col("x.shapes").alias("shape"), F.when(title, 0).otherwise(F.col("x.lengths")).alias("length"), "text", (F.col("text") <= ALONE).alias("alone"), ((code.bitwiseAND(B.TITLE | B.HEADING) != 0) | (code.bitwiseAND(B.CONTENT | B.SENTENCE | B.NOTICE) == B.CONTENT)).alias("content"))
        # mining is work for processors, not for the network: as many tasks as that needs, however few bytes there are
        parts = max(2 * scanned.sparkSession.sparkContext.defaultParallelism, scanned.count() // 50_000)
        counted = self.lines.groupBy("shape").agg(F.count("*").alias("lines"), F.count_if("alone").alias("alone"), F.count_if("content").alias("content"))
        known = scanned.where("shape is not null")
        if tree:
            # a path on which no line ever stands alone holds no notice; its shapes are judged by what they say
            lone = self.lines.where("alone").select("shape").distinct()
            open_ = known.select("shape", "leaf").join(lone, "shape", "left_semi").select("leaf").distinct()
            texts = known.select("shape", "leaf", "masked").join(open_, "leaf", "left_semi").dropDuplicates(["shape"])
            shapes = texts.join(counted, "shape")
        else:  # every shape a template of its own that nothing is known of
            shapes = known.select("shape", F.col("shape").alias("leaf"), "masked").dropDuplicates(["shape"]).join(counted.withColumn("alone", F.lit(0).cast("bigint")), "shape")
        shapes = shapes.select("shape", "leaf", "masked", "lines", "alone", "content").repartition(parts, "leaf").sortWithinPartitions("leaf", "masked")
        mined = materialize(shapes.mapInPandas(_mined, _MINED), "mined")
        self.templates = mined.where("template is not null").drop("shape").mapInPandas(_classified, f"{_MINED.replace('shape bigint, ', '')}, verdict string")
        judged = self.templates.where("verdict != ''").select("leaf", "number", "template", "verdict")
        found = mined.where("shape is not null").select("shape", "leaf", "number").join(judged, ["leaf", "number"]).select("shape", "template", "verdict")
        said = known.where("listed != ''").select("shape", F.col("masked").alias("template"), F.col("listed").alias("verdict"))
        #: (shape, template, verdict) of the shapes that a verdict was passed on
        self.shapes = materialize(found.unionByName(said).groupBy("shape").agg(F.max(F.struct("verdict", "template")).alias("v")).select("shape", "v.template", "v.verdict"), "judged")

    def verdicts(self) -> DataFrame:
        few = self.shapes.count() <= BROADCAST  # what residue looks like; beyond that both sides are sorted
        found = self.lines.hint("merge").join(self.shapes, "shape") if not few else self.lines.join(F.broadcast(self.shapes), "shape")
        of = lambda v: F.col("verdict") == v
        first = lambda v: F.min(F.when(of(v), F.struct("at", "template"))).alias(v)
        g = found.groupBy("row").agg(F.first("text").alias("text"), F.sum(F.when(of("notice"), F.col("length"))).alias("said"), *[first(v) for v in ("notice", "message", "filler")])
        slot = F.get(F.filter("slots", lambda s: ~F.get("flags", s["at"])), F.lit(0))["slot"]
        e = self.every.select("row", "page_id", slot.alias("slot")).join(g, "row", "left")
        notice = F.col("notice").isNotNull() & (F.col("text") - F.col("said") <= ALONE)
        kind = F.when(notice, "notice").when(F.col("message").isNotNull() | F.col("slot").isNotNull(), "slot").when(F.col("filler").isNotNull(), "filler").otherwise("")
        evidence = F.when(notice, F.col("notice.template")).when(F.col("message").isNotNull(), F.col("message.template")).otherwise(F.coalesce("slot", "filler.template", F.lit("")))
        return e.select("page_id", kind.alias("kind"), evidence.alias("evidence"))


def verdicts(pages: DataFrame, near: int = B.NEAR, tree: bool = True) -> DataFrame:
    """(page_id, kind, evidence) of every row of pages(page_id, url, title, text_content).

    kind is notice, slot, filler or "" (clean); evidence is the template or slot that decided.
    Null and empty texts are clean; repeated rows are judged again; an empty table gives an
    empty result; other columns are ignored. near=0 and tree=False leave differencing and
    mining out, to measure what they decide.
    """
    return Mined(pages, near, tree).verdicts()


def residue(pages: DataFrame) -> DataFrame:
    """(page_id) of the pages that hold residue or a notice in place of content."""
    return verdicts(pages).where("kind != ''").select("page_id")


def without_residue(pages: DataFrame) -> DataFrame:
    """The rows of ``pages`` that are neither residue nor notices, with all their columns; pages without id stay."""
    return pages.join(residue(pages).distinct(), "page_id", "left_anti")

"""The main body of pages, by differencing pages with their nearest neighbours by address.

1. Pages are read once where they lie; a line becomes a digest of its form (numbers and the
   site's name masked) and a few bits that say what kind of line it is. Only these travel.
2. Different pages of a host are put in order of path and numbered. Each is aligned with its
   ``NEAR`` nearest pages before and after it by the longest common subsequence of their
   lines; blocks of consecutive numbers overlap by ``NEAR`` pages, so that a host of any
   size is spread over tasks and no page lacks a neighbour for standing at a task's edge.
3. Over all hosts it is counted how many of the pages that have a form share it with a
   neighbour. Menus, notices and footers are shared by nearly all that have them; headings,
   labels and values, which pages of one kind have in common now and then, by few. Lines
   whose form is mostly shared are deleted, also on pages that have no neighbour.

Word lists decide only what differencing leaves open: lines put in here and there, whose
form is shared no more often than a heading, and the items that follow a teaser's heading,
which differ from page to page. What comes before a page's title is deleted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .patterns import FILLER, FILLER_ANYWHERE, MAYBE_SLOT, NOTICE_LINE, SLOT

#: Pages on either side that a page is aligned with, and pages in a block.
NEAR, BLOCK = 2, 512
#: Share of its pages that a boilerplate form is shared in, and hosts on which it must be before it counts on others.
MOSTLY, HOSTS = 0.5, 2
#: Bits above which an alignment is halved before it is traced back.
TRACE = 1 << 26

# What lines are that a page may have anywhere, in English, Spanish, German and French (from the start of a line in lower case).
OPEN_KINDS = (
    r"advertisement|publicidad|anzeige|werbung|publicité|sponsored|patrocinado|gesponsert|sponsorisé",
    r"(?:share|compartir|teilen|partager)\b.{0,20}:",
    r"add to compare|agregar a comparar|zum vergleich|ajouter au comparateur",
    r"(?:click|clic|cliquez)?\s?(?:to enlarge|para ampliar|zum vergrößern|pour agrandir)",
    r"(?:photo|foto|bild|image|imagen) \d+ (?:of|de|von|sur) \d+$",
    r"\d+ (?:people|personas|personen|personnes)\b",
    r"(?:get a quote|pida su cotización|angebot in \d|demandez un devis|sign up to|regístrese para|anmelden, um|inscrivez-vous pour)",
    r".{0,30}(?:helpful|útil|hilfreich|utile)\b.{0,3}\?",
    r"(?:read more|leer más|weiterlesen|lire la suite)\W*$",
    r"(?:read also|see also|lea también|lesen sie auch|à lire aussi|lire aussi)\s?:",
    r"your privacy choices|©|\(c\) |copyright\b",
)
# What such a line may speak of, anywhere.
OPEN_WORDS = ("cookie", "partner", "socios", "partenaires")
OPEN_TOPICS = r"\bcookies?\b|\b\d+ (?:partners|socios|partner|partenaires)\b"
TEASERS = r"(?:most read|lo más leído|meistgelesen|les plus lus|recently viewed|vistos recientemente|zuletzt angesehen|vus récemment|related models|modelos relacionados|ähnliche modelle|modèles similaires|you may also like|también le puede interesar|das könnte sie|vous aimerez aussi|top listings|avisos destacados|top-angebote|top-anzeigen|annonces vedettes|popular tags|etiquetas populares|beliebte schlagwörter|mots-clés populaires|latest news|últimas noticias|neueste meldungen|dernières nouvelles)\W*$"

#: Headings of sections, which the pages of a single host may all share.
HEADINGS = r"(?:dimensions|overview|key features|trial summary|performance|operator comfort|maintenance|engine|service notes|hydraulics|haul test|field results|specifications|descripción|dimensiones|ensayo de acarreo|mantenimiento|resultados en faena|especificaciones|motor|technische daten|abmessungen|überblick|einsatzbericht|wartung|aperçu|essai sur site|entretien|caractéristiques|moteur|hydraulik|hidráulica|hydraulique)$"

_OPEN = re.compile("|".join(f"(?:{p})" for p in OPEN_KINDS))
_OPEN_ANYWHERE = re.compile(OPEN_TOPICS)
_TEASER = re.compile(TEASERS)
_HEADING = re.compile(HEADINGS)
_NUMBER = re.compile(r"\d[\d.,]*")
_UNITS = r"(?:%|°|[a-zA-Z]{1,3}(?:/[a-z]{1,3})?[23³]?|ton|rpm|bar)"
_VALUE = re.compile(rf"^(?:.{{0,60}}?[\s:–-])?\d[\d.,]*\s*{_UNITS}$")
_BARE = re.compile(rf"^\d[\d.,]*\s*{_UNITS}$")
_TAG = re.compile(r"^.{2,50} \(\d+\)$")
_SENTENCE_END = re.compile(r"[.!?](?:\s|$)")
_ABBREVIATION = re.compile(r"\b(?:\w|No|Nr|St)\. ")
_CODE = re.compile(r"[A-Z]{2,3}[ -]?[A-Z]?\d{2,}|\d{3,}")
_CRUMBS = re.compile(r"^[^.!?]{2,40}(?: [/>»›] [^.!?/>»›]{2,40}){1,}$")
_MENU = re.compile(r"^[^\d.!?:]{2,40}(?: [|·•] [^\d.!?:|·•]{2,40}){1,}$|^[›≡☰»] ")
_BULLET = re.compile(r"^[-*•·–] ")
_DIGITS = frozenset("0123456789")
_LATER_DIGIT = re.compile(r"\d")

#: Bits of a line's kind.
TITLE, TEASER, TAG, TEXT, MACHINE, OPEN, CONTENT, BARE, CRUMBS, NOTICE, SHORT, MENU, ADDRESS, HEADING, SENTENCE = (1 << i for i in range(15))
_ITEM = TAG | TEXT | MACHINE


def masked(line: str) -> str:
    """A line without the numbers that differ from page to page."""
    return _NUMBER.sub("9", line.strip())


def site_names(host: str) -> list[str]:
    """Names by which a page would call its site: the labels of the host but for www and the last."""
    labels = [x for x in host.lower().split(":")[0].split(".")[:-1] if x not in ("www", "co", "com")]
    return [x.replace("-", " ") for x in labels if len(x) > 2]


def form(line: str, names: list[str]) -> int:
    """The digest of a stripped line: case, numbers and the site's names make no difference."""
    x = line.casefold()
    for s in names:
        x = x.replace(s, "@")
    if _DIGITS.isdisjoint(x):
        return xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63)
    return xxhash.xxh64_intdigest(_NUMBER.sub("9", x).encode("utf-8", "surrogatepass")) - (1 << 63)


def kinds(x: str) -> int:
    """The bits of a stripped line that don't depend on its page."""
    out, n, end, low = 0, len(x), x[-1], x.lower()
    short = n <= 200
    stands_in = bool(NOTICE_LINE.match(low))
    if stands_in:
        out |= NOTICE
    stands_in = stands_in or bool((MAYBE_SLOT.search(x) and SLOT.search(x)) or FILLER.match(low) or (("lorem" in low or "dummy" in low) and FILLER_ANYWHERE.search(low)))
    if short and _TEASER.match(low):
        out |= TEASER
    if _OPEN.match(low) or (any(w in low for w in OPEN_WORDS) and _OPEN_ANYWHERE.search(low)):
        out |= OPEN
    value, bullet = n <= 100 and not _DIGITS.isdisjoint(x) and bool(_VALUE.match(x)), x[0] in "-*•·–" and bool(_BULLET.match(x))
    if value or bullet or stands_in:
        out |= CONTENT
    elif x.count(" ") >= 7 and _SENTENCE_END.search(x[-3:]):
        out |= CONTENT | SENTENCE
    if value and _BARE.match(x):
        out |= BARE
    if end == ")" and n <= 60 and _TAG.match(x):
        out |= TAG
    elif end == "…" or x.endswith("..."):
        out |= TEXT
    elif not (bullet or value or stands_in):
        if end in ".!?":
            if n > 40 and _sentences(x) == 1:
                out |= TEXT
        elif n <= 60 and ":" not in x and _CODE.search(x) and not _sentences(x):
            out |= MACHINE
    if short:
        if (" / " in x or " > " in x or " » " in x or " › " in x) and _CRUMBS.match(x):
            out |= CRUMBS
        if (x[0] in "›≡☰»" or " | " in x or " · " in x or " • " in x) and _MENU.match(x):
            out |= MENU
    if n <= 40 and _HEADING.match(low):
        out |= HEADING
    elif n <= 25 and x.count(" ") <= 1 and not any(c.isdigit() for c in x):
        out |= SHORT
    return out


def _sentences(x: str) -> int:
    if ". " in x:
        x = _ABBREVIATION.sub("", x)
    return len(_SENTENCE_END.findall(x))


class Reader:
    """Lines of texts to bits and forms. What doesn't depend on the page is kept for lines that come again; the memory is bounded and forgets nothing but work."""

    def __init__(self, most: int = 50_000):
        self.most, self.bits, self.forms, self.host = most, {}, {}, None

    def __call__(self, text: str, title: str | None, host: str) -> tuple[list[str], list[int], list[int], list[int]]:
        """(stripped non-blank lines, their numbers, bits and forms)."""
        if host != self.host:
            self.host, self.names = host, site_names(host)
        if len(self.bits) > self.most:
            self.bits = {}
        if len(self.forms) > self.most:
            self.forms = {}
        key, names = (title or "").strip().casefold(), self.names
        numbers, lines, codes, forms = [], [], [], []
        for i, x in enumerate(text.split("\n"), 1):
            x = x.strip()
            if not x:
                continue
            c, f = self.bits.get(x), self.forms.get(x)
            if c is None:
                c = self.bits[x] = kinds(x)
            if f is None:
                f = self.forms[x] = (x.casefold(), form(x, []))
            low, f = f
            for s in names:
                if s in low:
                    f = form(x, names)
                    if len(x) <= 80 and "," in x and any(low.startswith(s) for s in names) and _LATER_DIGIT.search(x, 3):
                        c |= ADDRESS
                    break
            if low == key:
                c |= TITLE
            numbers.append(i)
            lines.append(x)
            codes.append(c)
            forms.append(f)
        return lines, numbers, codes, forms


def _grown(a: list[int], places: dict[int, int], m: int) -> int:
    """The last row of the bit-parallel alignment: a zero at place j where the common subsequence grows."""
    full = (1 << m) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return v


def _places(b: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for j, x in enumerate(b):
        out[x] = out.get(x, 0) | 1 << j
    return out


def common_lines(a: list, b: list) -> list[bool]:
    """Which lines of ``a`` are on a longest common subsequence with ``b``.

    Bit-parallel: a word operation per line and machine word. Rows are kept only for small
    pairs; larger ones are halved where the two halves' subsequences fit best, so memory
    grows with the number of lines and not with its square.
    """
    n, m = len(a), len(b)
    hit = [False] * n
    lo = 0
    while lo < min(n, m) and a[lo] == b[lo]:
        hit[lo] = True
        lo += 1
    hi = 0
    while hi < min(n, m) - lo and a[n - 1 - hi] == b[m - 1 - hi]:
        hit[n - 1 - hi] = True
        hi += 1
    a, b = a[lo : n - hi], b[lo : m - hi]
    have = set(b)
    kept = [i for i, x in enumerate(a) if x in have]  # others are on no common subsequence
    if not kept:
        return hit
    inner = _traced([a[i] for i in kept], b)
    for i, h in zip(kept, inner):
        hit[lo + i] = h
    return hit


def _traced(a: list, b: list) -> list[bool]:
    if len(a) * len(b) > TRACE and len(a) > 1:
        half, m = len(a) // 2, len(b)
        bits = lambda v: np.unpackbits(np.frombuffer(v.to_bytes((m + 7) // 8, "little"), np.uint8), bitorder="little")[:m] ^ 1
        ahead = np.concatenate(([0], np.cumsum(bits(_grown(a[:half], _places(b), m)), dtype=np.int64)))
        back = np.concatenate(([0], np.cumsum(bits(_grown(a[half:][::-1], _places(b[::-1]), m)), dtype=np.int64)))[::-1]
        cut = int(np.argmax(ahead + back))
        return common_lines(a[:half], b[:cut]) + common_lines(a[half:], b[cut:])
    places, full = _places(b), (1 << len(b)) - 1
    rows, v = [], full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    hit = [False] * len(a)
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if not rows[i] >> j & 1 and (i == 0 or rows[i - 1] >> j & 1):
            hit[i] = a[i] == b[j]
            if hit[i]:
                i -= 1
            j -= 1
        elif rows[i] >> j & 1:
            j -= 1
        else:
            i -= 1
    return hit


def content_start(codes: list[int]) -> int:
    """The line that the content begins with: the title, else what stands in its place; -1 where neither is found."""
    return next((i for i, c in enumerate(codes) if c & TITLE), next((i for i, c in enumerate(codes) if c & NOTICE), -1))


def boilerplate_lines(codes: list[int], numbers: list[int], shared: list[bool], spread: list[int]) -> list[bool]:
    """For each non-blank line whether it is boilerplate.

    codes: bits of kind; numbers: line numbers, of which gaps are blank lines; shared: whether
    a neighbour has the line; spread: 2 if the line's form is mostly shared on several hosts,
    1 if on one, else 0.
    """
    n = len(codes)
    out = [False] * n
    start = content_start(codes)
    untitled = start < 0
    if untitled and (crumbs := next((i for i, c in enumerate(codes) if c & CRUMBS), None)) is not None:
        start = next((i for i in range(crumbs + 1, n) if not (codes[i] & OPEN or spread[i] == 2)), -1)
    teaser = None  # the kind of a teaser's items, 0 before the first one
    for i, c in enumerate(codes):
        if i and numbers[i] > numbers[i - 1] + 1:
            teaser = None
        if i <= start:
            out[i] = i < start
            continue
        if c & TEASER:
            out[i], teaser = True, 0
            continue
        differs = c & NOTICE or (c & BARE) or (i + 1 < n and codes[i + 1] & BARE)  # notices in place of content; values and their labels
        if not differs and (spread[i] == 2 or (shared[i] and not c & (CONTENT | HEADING) and (spread[i] == 1 or start < 0))):
            out[i] = True
            continue
        if c & (OPEN | ADDRESS | MENU) and not c & NOTICE:
            out[i] = True
            continue
        if teaser is not None:
            kind = c & _ITEM
            if kind and teaser in (0, kind):
                out[i], teaser = True, kind
                continue
            teaser = None
    if start < 0:  # no title to be found: the top is what a menu, crumbs or notices make up
        for i, c in enumerate(codes):
            if not out[i]:
                if c & SHORT and (any(out[:i]) or any(out[i + 1 : i + 4])):
                    out[i] = True
                else:
                    break
    return out


# --- 1: pages to lines

PAGE = "row bigint, page_id bigint, host string, path string, body bigint, start int, codes array<smallint>, numbers array<int>, forms array<bigint>"


def _row_numbers():
    """Numbers of a task's rows that no other task has; they are written before they are used."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return (task.partitionId() if task else 0) << 36


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _scan_numbered(_numbered(batches))


def _scan_numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = Reader()
    for b in batches:
        host, title, text = (b.column(i).to_pylist() for i in (2, 4, 5))
        body, start, codes, numbers, forms = [], [], [], [], []
        for h, t, x in zip(host, title, text):
            _, n, c, f = read(x or "", t, h)
            body.append(xxhash.xxh64_intdigest((x or "").encode("utf-8", "surrogatepass")) - (1 << 63))
            start.append(content_start(c))
            codes.append(c)
            numbers.append(n)
            forms.append(f)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(body, pa.int64()), pa.array(start, pa.int32()), pa.array(codes, pa.list_(pa.int16())), pa.array(numbers, pa.list_(pa.int32())), pa.array(forms, pa.list_(pa.int64()))], names=["row", "page_id", "host", "path", "body", "start", "codes", "numbers", "forms"])


def addressed(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, title, text): www and case of hosts, and numbers in paths make no difference."""
    url = F.coalesce("url", F.lit(""))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^\s*(?i)(?:https?:)?//([^/?#\s]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(url, r"^\s*(?i)(?:https?:)?//[^/?#]*", ""), r"\d+", "")
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"), "title", F.col("text_content").alias("text"))


# --- 2: neighbours

_ALIGNED = "host string, body bigint, beside boolean, start int, forms array<bigint>, shared array<boolean>"


def _aligned(batches: Iterator[pd.DataFrame], near: int) -> Iterator[pd.DataFrame]:
    """Blocks of pages in order to the pages of each with the lines that neighbours share; pages of another block are neighbours only."""

    def done(block: list) -> pd.DataFrame:
        rows = []
        for i, p in enumerate(block):
            if not p.own:
                continue
            lines, hit = p.forms, np.zeros(len(p.forms), bool)
            beside = [q for q in block[max(0, i - near) : i] + block[i + 1 : i + 1 + near] if q.host == p.host]
            for q in beside:
                hit |= np.array(common_lines(lines, q.forms), bool)
            rows.append((p.host, p.body, bool(beside), p.start, p.forms, hit))
        return pd.DataFrame(rows, columns=["host", "body", "beside", "start", "forms", "shared"])

    block: list = []
    for b in batches:
        for row in b.itertuples(index=False):
            if block and row.block != block[0].block:
                yield done(block)
                block = []
            block.append(row._replace(forms=row.forms.tolist()))  # once, and not for every neighbour
    yield done(block)


def aligned(lines: DataFrame, near: int = NEAR) -> DataFrame:
    """Per different page of a host: whether it has neighbours, and which of its lines one of them has too."""
    spark = lines.sparkSession
    order = ["host", "path", "page_id", "row"]
    one = lines.groupBy("host", "body").agg(F.min_by(F.struct("path", "page_id", "row", "start", "forms"), F.struct("path", F.coalesce("page_id", F.lit(0)), "row")).alias("p"))
    one = one.select("host", "body", "p.*").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(one.withColumn("at", F.monotonically_increasing_id()), "order")
    before, offsets = 0, []
    for r in placed.groupBy(F.shiftright("at", 33).alias("task")).count().orderBy("task").collect():  # one row per task
        offsets.append((r["task"], before))
        before += r["count"]
    offset = F.broadcast(spark.createDataFrame(offsets, "task bigint, offset bigint"))
    numbered = placed.withColumn("task", F.shiftright("at", 33)).join(offset, "task").withColumn("at", F.col("offset") + F.col("at").bitwiseAND((1 << 33) - 1))
    own, inner = F.floor(F.col("at") / BLOCK), F.col("at") % BLOCK
    blocks = F.array_compact(F.array(own, F.when(inner < near, own - 1), F.when(inner >= BLOCK - near, own + 1)))
    copies = numbered.withColumn("own_block", own).withColumn("block", F.explode(blocks)).select("block", "at", (F.col("block") == F.col("own_block")).alias("own"), "host", "body", "start", "forms")
    copies = copies.repartition("block").sortWithinPartitions("block", "at")
    return copies.mapInPandas(lambda it: _aligned(it, near), _ALIGNED)


# --- 3: forms over all hosts


def spread_forms(pages: DataFrame) -> DataFrame:
    """(form, spread): forms of lines after the content's start that are mostly shared, 2 on several hosts, 1 on one."""
    lines = pages.where("beside and start >= 0").select("host", F.explode(F.array_distinct(F.slice(F.arrays_zip("forms", "shared"), F.col("start") + 2, F.greatest(F.size("forms"), F.lit(1))))).alias("x"))
    per_host = lines.groupBy(F.col("x.forms").alias("form"), "host").agg(F.count("*").alias("pages"), F.count_if("x.shared").alias("shared"))
    per_form = per_host.groupBy("form").agg(F.sum("pages").alias("pages"), F.sum("shared").alias("shared"), F.count_if(F.col("shared") > 0).alias("hosts"))
    return per_form.where(F.col("shared") >= MOSTLY * F.col("pages")).select("form", F.when(F.col("hosts") >= HOSTS, 2).otherwise(1).cast("tinyint").alias("spread"))


def _judged(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        column = lambda c: b.column(b.schema.get_field_index(c))
        flags = []
        for codes, numbers, forms, shared, found in zip(*(column(c).to_pylist() for c in ("codes", "numbers", "forms", "shared", "spread"))):
            spread = {} if found is None else {x["form"]: x["spread"] for x in found}
            flags.append(boilerplate_lines(codes, numbers, shared or [False] * len(codes), [spread.get(f, 0) for f in forms]))
        yield pa.RecordBatch.from_arrays([*(column(c) for c in keep), pa.array(flags, pa.list_(pa.bool_()))], names=[*keep, "flags"])


def flagged(lines: DataFrame, near: int = NEAR, keep: tuple[str, ...] = ("numbers",)) -> DataFrame:
    """(row, page_id, keep..., flags) of scanned pages: which of the non-blank lines are boilerplate. near=0 leaves differencing out."""
    sides = materialize(aligned(lines, near), "aligned")
    every = sides.select("host", "body", F.explode(F.array_distinct("forms")).alias("form"))
    found = every.join(spread_forms(sides), "form").groupBy("host", "body").agg(F.collect_list(F.struct("form", "spread")).alias("spread"))  # at most a page's lines
    known = sides.select("host", "body", "shared").join(found, ["host", "body"], "left")
    keep = ["row", "page_id", *keep]
    both = lines.select(*dict.fromkeys([*keep, "host", "body", "codes", "numbers", "forms"])).join(known, ["host", "body"], "left").drop("host", "body")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in lines.select(*keep).schema), "flags array<boolean>"])
    return both.mapInArrow(lambda it: _judged(it, keep), schema)


def boilerplate(pages: DataFrame, near: int = NEAR) -> DataFrame:
    """(page_id, line_no) of each non-blank boilerplate line of pages(page_id, url, title, text_content).

    Lines count from 1 over all lines that end-of-line characters separate. Null and empty
    texts have none; pages without address are neighbours of each other; repeated rows give
    their lines again. An empty table gives an empty result; other columns are ignored.
    """
    lines = materialize(addressed(pages).mapInArrow(_scan, PAGE), "lines")
    found = flagged(lines, near).select("page_id", F.filter(F.transform(F.arrays_zip("numbers", "flags"), lambda x: F.when(x["flags"], x["numbers"])), lambda n: n.isNotNull()).alias("at"))
    return found.select("page_id", F.explode("at").alias("line_no"))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for text, gone in zip(b["text"], b["gone"]):
            drop = set() if gone is None else set(gone.tolist())
            out.append(None if text is None else "\n".join(x for i, x in enumerate(text.split("\n"), 1) if i not in drop))
        yield pd.DataFrame({"page_id": b["page_id"], "body": out})


def bodies(pages: DataFrame, near: int = NEAR) -> DataFrame:
    """(page_id, body): the texts without their boilerplate lines; null stays null."""
    texts = materialize(addressed(pages).mapInArrow(_numbered, "row bigint, page_id bigint, host string, path string, title string, text string"), "texts")
    lines = materialize(texts.mapInArrow(_scan_numbered, PAGE), "lines")
    gone = flagged(lines, near).select("row", F.filter(F.transform(F.arrays_zip("numbers", "flags"), lambda x: F.when(x["flags"], x["numbers"])), lambda n: n.isNotNull()).alias("gone"))
    return texts.join(gone, "row", "left").select("page_id", "text", "gone").mapInPandas(_cut, "page_id bigint, body string")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = _row_numbers()
    for b in batches:
        n = b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), *b.columns], names=["row", "page_id", "host", "path", "title", "text"])
        row += n

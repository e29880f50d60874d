"""Cutting oversized texts at natural boundaries, by dynamic programming.

Candidate cuts are all paragraph, line, sentence, clause and word ends of a text. The
program minimises the sum of the cuts' penalties and of the pieces' squared deviations
from an even length, subject to the maximum length; each piece but the first begins with
the last ``overlap`` characters of the one before. Where a stretch has no boundary,
cuts between characters are allowed at the highest penalty.

Only oversized texts reach Python; each is handled alone, so no shuffle takes place.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Penalties of a cut, from a paragraph's end down to a cut between any two characters.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, ANYWHERE = 0.0, 0.3, 0.6, 1.5, 3.0, 12.0
IMBALANCE = 4.0
_KINDS = (
    (re.compile(r"\n[^\S\n]*\n\s*"), PARAGRAPH),
    (re.compile(r"\n"), LINE),
    (re.compile(r"[.!?…]+[\"'»”)\]]*\s+|[。！？]+[」』”]*\s*"), SENTENCE),
    (re.compile(r"[;:,，；：、]\s*(?!\d)"), CLAUSE),
    (re.compile(r"\s+"), WORD),
)


def boundaries(text: str, gap: int) -> dict[int, float]:
    """Position after a boundary -> its least penalty.

    Weaker kinds are only taken where the stronger ones leave a stretch longer than ``gap``;
    cuts between any two characters only where no kind breaks such a stretch.
    """
    at: dict[int, float] = {}
    n = len(text)
    open_ = [(0, n)]
    for pattern, cost in _KINDS:
        left = []
        for a, b in open_:
            prev = a
            for m in pattern.finditer(text, a, b):
                e = m.end()
                if a < e < b:
                    at[e] = cost
                    if e - prev > gap:
                        left.append((prev, e))
                    prev = e
            if b - prev > gap:
                left.append((prev, b))
        open_ = left
    for a, b in open_:
        for e in range(a + gap, b, max(1, gap // 4)):
            at[e] = ANYWHERE
    return at


def cuts(text: str, limit: int, overlap: int) -> list[int]:
    """Positions at which to cut ``text``; the piece after a cut starts ``overlap`` characters before it."""
    n = len(text)
    if n <= limit:
        return []
    step = limit - overlap
    pieces = 1 + math.ceil((n - limit) / step)
    even = (n - overlap) / pieces  # new characters of each piece, were they equal
    cost = boundaries(text, max(1, step // 8))
    at = [0, *sorted(cost), n]
    best, back = [math.inf] * len(at), [0] * len(at)
    best[0] = 0.0
    for j in range(1, len(at)):
        end = at[j]
        own = 0.0 if end == n else cost[end]
        for i in range(bisect.bisect_left(at, end - limit, 0, j), j):
            new = end - at[i]  # up to limit for the first piece, limit - overlap for the others
            if best[i] == math.inf or (i > 0 and (new > step or at[i] < overlap)):
                continue
            size = (new - (overlap if i == 0 else 0)) / even - 1
            total = best[i] + own + IMBALANCE * size * size
            if total < best[j]:
                best[j], back[j] = total, i
    out, j = [], len(at) - 1
    while back[j]:
        j = back[j]
        out.append(at[j])
    return out[::-1]


def split(text: str, limit: int, overlap: int) -> list[tuple[int, str]]:
    """(start, piece) of each piece."""
    ends = [*cuts(text, limit, overlap), len(text)]
    starts = [0, *(e - overlap for e in ends[:-1])]
    return [(s, text[s:e]) for s, e in zip(starts, ends)]


def _pieces(batches: Iterator[pd.DataFrame], limit: int, overlap: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for kind, item, text in zip(b["item_kind"], b["item_id"], b["text"]):
            p = split(text, limit, overlap)
            rows += [(kind, item, i, len(p), s, len(t), t) for i, (s, t) in enumerate(p)]
        yield pd.DataFrame(rows, columns=["item_kind", "item_id", "piece_no", "pieces", "start", "length", "text"])


SCHEMA = "item_kind string, item_id string, piece_no int, pieces int, start int, length int, text string"


def oversized(items: DataFrame, limit: int = 4000, overlap: int = 200) -> DataFrame:
    """The pieces of the items longer than ``limit`` (code points); see :func:`split_items`."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be at least 0 and less than half the limit")
    big = items.where(F.length("text") > limit).select("item_kind", F.col("item_id").cast("string").alias("item_id"), "text")
    return big.mapInPandas(lambda it: _pieces(it, limit, overlap), SCHEMA)


def split_items(items: DataFrame, limit: int = 4000, overlap: int = 200) -> DataFrame:
    """Pieces of at most ``limit`` code points of items(item_kind, item_id, text).

    Returns (item_kind, item_id, piece_no, pieces, start, length, text). An item within the
    limit is one piece; null and empty texts give no piece; repeated rows give their pieces
    again. Joining the pieces without the first ``overlap`` characters of each but the first
    gives the text back. Other columns are ignored.
    """
    small = items.where((F.length("text") > 0) & (F.length("text") <= limit)).select(
        "item_kind", F.col("item_id").cast("string").alias("item_id"), F.lit(0).alias("piece_no"), F.lit(1).alias("pieces"), F.lit(0).alias("start"), F.length("text").alias("length"), "text"
    )
    return small.unionByName(oversized(items, limit, overlap))


def items(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Page and chunk texts as items."""
    named = lambda kind, key, text: [F.lit(kind).alias("item_kind"), F.col(key).cast("string").alias("item_id"), F.col(text).alias("text")]
    return pages.select(*named("page", "page_id", "text_content")).unionByName(chunks.select(*named("chunk", "chunk_id", "text")))

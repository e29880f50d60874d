"""Encoding a corpus with a public tokenizer, sharing the work on repeated passages.

Texts are cut into content-defined chunks: a rolling hash over the last characters picks
the cuts, so that a passage that stands in many documents is cut alike in each. Equal
chunks are merged before the shuffle, encoded once wherever they meet, and their ids go
back to the documents. A cut is exact where no token can reach across it, which the
tokenizer's splitting pattern tells for the character classes on both sides (a word, a
number or a mark ends before white space). Where a stretch offers no such place the cut
is forced, and the join is repaired: the chunks on both sides are encoded again as one
until an exact place bounds them.

The vocabulary's path is a parameter; each Python worker loads it once.
"""

from __future__ import annotations

import base64
import functools
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The splitting pattern of this family of byte-level tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters hashed at a place, mean distance of cuts, and the longest chunk before a cut is forced.
WINDOW, MEAN, LONGEST = 16, 1024, 1 << 16
#: Places of a chunk in one batch beyond which its rows are spread over several tasks.
PLACES = 64


def vocabulary_dir() -> str:
    """The folder of the public vocabularies: $TOKENIZERS, else that of the installed package."""
    if "TOKENIZERS" in os.environ:
        return os.environ["TOKENIZERS"]
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec else "/opt/tokenizers"


@functools.cache
def tokenizer(path: str):
    """A byte-level BPE from a file of ranks (base64 token, rank)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _weights() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


def exact_places(codes: np.ndarray) -> np.ndarray:
    """For each place between two characters whether no token reaches across it: a blank or line end after a character that isn't white space."""
    space = (codes == 32) | (codes == 10)
    white = space | (codes < 32) | ((codes >= 0x7F) & (codes <= 0xA0)) | (codes == 0x1680) | ((codes >= 0x2000) & (codes <= 0x200F)) | ((codes >= 0x2028) & (codes <= 0x202F)) | (codes == 0x205F) | (codes == 0x3000) | (codes == 0xFEFF)
    out = np.zeros(len(codes) + 1, bool)
    out[1:-1] = space[1:] & ~white[:-1]
    # a CJK sign before a CJK stop: letters end before marks
    cjk = (codes >= 0x4E00) & (codes <= 0x9FA5)
    stop = (codes == 0xFF0C) | (codes == 0x3002) | (codes == 0xFF1B) | (codes == 0x3001)
    out[1:-1] |= stop[1:] & cjk[:-1]
    return out


def word_places(codes: np.ndarray) -> np.ndarray:
    """Further places that no token reaches across: between ASCII letters, digits and marks. A mark before them is no apostrophe, which may begin a contraction."""
    letter = ((codes | 32) >= 97) & ((codes | 32) <= 122) & (codes < 128)
    digit = (codes >= 48) & (codes <= 57)
    mark = (codes > 32) & (codes < 127) & ~letter & ~digit
    out = np.zeros(len(codes) + 1, bool)
    a, b = slice(None, -1), slice(1, None)
    out[1:-1] = (letter[a] & (digit[b] | mark[b])) | (digit[a] & (letter[b] | mark[b])) | (mark[a] & (codes[a] != 39) & (letter[b] | digit[b]))
    return out


def cut_all(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the chunks of all texts, in order; starts and ends count characters of the texts joined."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    exact = exact_places(codes)
    at = np.flatnonzero(exact)  # the hash is only needed there
    h = np.zeros(len(at), np.uint64)
    if len(codes):
        wide = codes.astype(np.uint64)
        w = _weights()
        for k in range(WINDOW):
            pos = at - 1 - k
            h += np.where(pos >= 0, wide[np.maximum(pos, 0)], np.uint64(0)) * w[k]
    # places that may be cut are every sixth character or so
    share = max(1, MEAN // 6)
    picked = at[(h >> np.uint64(33)) % np.uint64(share) == 0]
    doc = np.searchsorted(bounds, picked, side="right") - 1
    inner = picked[(picked > bounds[doc]) & (picked < bounds[doc + 1])]
    points = np.unique(np.concatenate((inner, bounds)))
    start, end = points[:-1], points[1:]
    keep = end > start
    start, end = start[keep], end[keep]
    if len(start) and (end - start).max() > LONGEST:  # stretches without a picked place
        more = [np.arange(s + LONGEST, e, LONGEST) for s, e in zip(start, end) if e - s > LONGEST]
        forced = np.concatenate(more)
        at = np.flatnonzero(exact | word_places(codes))
        near = at[np.clip(np.searchsorted(at, forced), 0, max(len(at) - 1, 0))] if len(at) else forced
        forced = np.where(np.abs(near - forced) < LONGEST // 4, near, forced)
        points = np.unique(np.concatenate((points, forced)))
        start, end = points[:-1], points[1:]
    number = np.searchsorted(bounds, start, side="right") - 1
    return start, end, number


def join_forced(start: np.ndarray, end: np.ndarray, number: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repair: chunks whose join isn't exact become one, as encoding them again as one would give. What is left of these are single words longer than LONGEST, which byte pairs must see whole."""
    if not len(start):
        return start, end, number
    inner = np.concatenate(([False], (number[1:] == number[:-1]) & ~exact[start[1:]]))
    first = ~inner
    last = np.concatenate((first[1:], [True]))
    return start[first], end[last], number[first]


def chunks(texts: list[str]) -> list[list[str]]:
    """The chunks of each text; each may be encoded alone."""
    joined = "".join(texts)
    start, end, number = cut_all(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    exact = exact_places(codes)
    if len(start) and (~exact[start[1:][number[1:] == number[:-1]]]).any():
        exact |= word_places(codes)
    start, end, number = join_forced(start, end, number, exact)
    out: list[list[str]] = [[] for _ in texts]
    for s, e, d in zip(start.tolist(), end.tolist(), number.tolist()):
        out[d].append(joined[s:e])
    return out


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per different chunk of a batch, with the documents and places where it stands."""
    for b in batches:
        docs = b.column(0).to_pylist()
        where: dict[str, tuple[list[int], list[int]]] = {}
        for doc, parts in zip(docs, chunks(b.column(1).to_pylist())):
            for i, part in enumerate(parts):
                d, p = where.setdefault(part, ([], []))
                d.append(doc)
                p.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(where), pa.string()), pa.array([d for d, _ in where.values()], pa.list_(pa.int64())), pa.array([p for _, p in where.values()], pa.list_(pa.int32()))],
            names=["chunk", "docs", "places"],
        )


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(doc, place, ids as bytes) of every place; equal chunks of a batch are encoded once."""
    enc = tokenizer(path)
    width = np.uint16 if enc.n_vocab <= 1 << 16 else np.uint32
    for b in batches:
        pieces = pc.dictionary_encode(b.column(0))
        once = [np.asarray(enc.encode_ordinary(t), width).tobytes() for t in pieces.dictionary.to_pylist()]
        docs, places = b.column(1), b.column(2)
        rows = pc.list_parent_indices(docs)
        ids = pc.take(pa.array(once, pa.binary()), pc.cast(pc.take(pieces.indices, rows), pa.int64()))
        yield pa.RecordBatch.from_arrays([pc.list_flatten(docs), pc.list_flatten(places), ids], names=["doc_id", "place", "ids"])


def _once(places: list[int], ids: list[bytes]) -> list[bytes]:
    """The parts of one text, in order; a row that came twice gives each place twice."""
    if places and places[-1] + 1 == len(places):
        return ids
    return list(dict(zip(places, ids)).values())


def _assembled(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    width = np.uint16 if tokenizer(path).n_vocab <= 1 << 16 else np.uint32
    for b in batches:
        parts = [b"".join(_once(p, x)) for p, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(width).itemsize
        flat = np.frombuffer(b"".join(parts), width).astype(np.int32)
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of documents(doc_id bigint, text), without special tokens.

    Null and empty texts have an empty list; very long texts are cut like all others.
    doc_id must be unique for different texts; a row that comes twice comes out once. An
    empty table gives an empty result; other columns are ignored.
    """
    path = path or os.path.join(vocabulary_dir(), "byte_bpe_50k.tiktoken")
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    full = docs.where(F.length("text") > 0)
    parts = full.mapInArrow(_chunked, "chunk string, docs array<bigint>, places array<int>")
    # equal chunks meet in one task, those of a passage that most documents have in more the more places a batch has: each encodes it once more, none has all its places
    salt = F.pmod(F.xxhash64(F.get("docs", F.lit(0))), F.greatest(F.floor(F.size("docs") / PLACES), F.lit(1)))
    placed = parts.repartition(F.xxhash64("chunk", salt)).mapInArrow(lambda it: _encoded(it, path), "doc_id bigint, place int, ids binary")
    lists = placed.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("place", "ids"))).alias("parts")).select("doc_id", F.col("parts.place").alias("places"), F.col("parts.ids").alias("parts"))
    ids = lists.mapInArrow(lambda it: _assembled(it, path), "doc_id bigint, ids array<int>")
    empty = docs.where(F.coalesce(F.length("text"), F.lit(0)) == 0).select("doc_id", F.array().cast("array<int>").alias("ids"))
    return ids.unionByName(empty)

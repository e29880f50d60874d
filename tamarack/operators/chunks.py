"""Overlapping chunks of words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_words(docs: DataFrame, size: int = 512, overlap: int = 50, text: str = "text", url: str = "url", name: list[str] | None = None) -> DataFrame:
    """Chunks of ``size`` words, each beginning ``size - overlap`` words after the one before: the other columns with chunk_no, chunk_id, chunk and words.

    The last chunk may lie wholly inside the one before it. The id joins the ``name`` columns,
    eight digits of the address's hash, and the number. Null and blank texts have none.
    """
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("size must be 1 or more, and overlap at least 0 and less than size")
    keep = [c for c in docs.columns if c != text]
    words = F.filter(F.split(F.col(text), r"(?U)\s+"), lambda w: w != "")
    df = docs.select(*keep, words.alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.size("_w") - 1, F.lit(size - overlap))
    out = df.select(*keep, "_w", F.posexplode(starts).alias("chunk_no", "_s"))
    part = F.slice("_w", F.col("_s") + 1, size)
    ident = F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (name or [])], F.substring(F.sha2(F.coalesce(F.col(url).cast("string"), F.lit("")), 256), 1, 8), F.col("chunk_no").cast("string"))
    return out.select(*keep, "chunk_no", ident.alias("chunk_id"), F.array_join(part, " ").alias("chunk"), F.size(part).alias("words"))

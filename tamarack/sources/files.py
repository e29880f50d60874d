"""Files: stored search responses, raw pages, PDF documents, and tables in common formats."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_PAGE, MAX_PDF = 10 << 20, 50 << 20
_ITEM = "array<struct<title:string,link:string,snippet:string>>"


def search_responses(spark: SparkSession, path: str) -> DataFrame:
    """Results in stored JSON responses of either engine: (file, seq, title, url, snippet, source_engine)."""
    raw = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    j = raw.withColumn("j", F.from_json("value", f"items {_ITEM}, organic {_ITEM}"))
    one = lambda c, engine: j.where(F.col(f"j.{c}").isNotNull()).select("file", F.posexplode(f"j.{c}").alias("seq", "r")).select("file", "seq", "r.title", F.col("r.link").alias("url"), "r.snippet", F.lit(engine).alias("source_engine"))
    return one("items", "google").unionByName(one("organic", "serper"))


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html) of HTML files of at most 10 MiB; the size is checked before a file is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.htm*").load(path).where(F.col("length") <= MAX_PAGE)
    return files.select("path", F.decode("content", "UTF-8").alias("html"))


def pdf_documents(spark: SparkSession, path: str, parse: Callable[[bytes], tuple[list[str], list]]) -> DataFrame:
    """(path, title, text_content, tables) of PDF files of at most 50 MiB. ``parse`` gives a document's page texts and tables; documents that it fails on fall out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).where(F.col("length") <= MAX_PDF).select("path", "content")

    def run(batches):
        for b in batches:
            rows = []
            for p, content in zip(b["path"], b["content"]):
                try:
                    texts, tables = parse(bytes(content))
                except Exception:  # a broken document mustn't end the job
                    continue
                cells = [[[c if c is not None else "" for c in row] for row in t] for t in tables]
                rows.append((p, "PDF: " + p.rsplit("/", 1)[-1], "\n\n".join(texts), cells))
            yield pd.DataFrame(rows, columns=["path", "title", "text_content", "tables"])

    return files.mapInPandas(run, "path string, title string, text_content string, tables array<array<array<string>>>")


def read_table(spark: SparkSession, path: str, kind: str | None = None, schema: str | None = None) -> DataFrame:
    """A table in parquet, orc, json or csv (with header), by ``kind`` or the path's ending."""
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1]
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "csv":
        return reader.option("header", True).csv(path)
    return {"parquet": reader.parquet, "orc": reader.orc, "json": reader.json}[kind](path)

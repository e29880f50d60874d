"""Continuous ingestion: new pages into facts, each address once, and the warehouse kept up to date.

The transformations are those of the batch operators; only what needs state is here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import specs, warehouse


def page_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of pages as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def new_pages(pages: DataFrame, delay: str = "7 days", at: str = "scraped_at") -> DataFrame:
    """Each address once. A page later than ``delay`` behind the newest one is taken for new, since its address has been forgotten."""
    return pages.withWatermark(at, delay).dropDuplicatesWithinWatermark(["url"])


def facts(pages: DataFrame) -> DataFrame:
    """Facts in the texts and tables of pages, row by row."""
    keep = ["page_id", "url", "scraped_at"]
    text = specs.from_text(pages.select(*keep, F.col("text_content").alias("text")))
    tables = specs.from_tables(pages.select(*keep, "tables"))
    return tables.unionByName(text.withColumn("seq", F.col("seq") + 10**12))


def _timed(events: DataFrame) -> DataFrame:
    """Watermarks need a time with zone; a time without one is taken as of the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def events_per_window(events: DataFrame, window: str = "10 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts and sums per type in tumbling or sliding windows; later events than ``delay`` are dropped."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    g = _timed(events).withWatermark("ts", delay).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "events", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions per user: events with pauses of less than ``gap``."""
    g = _timed(events).withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("events"))
    return g.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "user_id", "events")


def into_warehouse(stream: DataFrame, store: warehouse.Warehouse, table: str, keys: list[str], checkpoint: str, on_batch: Callable[[DataFrame, int], None] | None = None):
    """A query that puts each batch's rows in place of those of the same key; a batch that is run again changes nothing."""

    def put(batch: DataFrame, number: int) -> None:
        rows = batch.dropDuplicates(keys)
        store.upsert(table, rows, keys)  # writes the buckets that the batch falls into
        if on_batch:
            on_batch(rows, number)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)

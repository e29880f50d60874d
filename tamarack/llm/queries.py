"""Queries of this subpackage, and the SQL that they are checked against where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, shared_dir, table, tune
from . import boilerplate, encoding, incremental, mixing, neighbors, residue, spans, splitting, survivors


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_survivors(spark, sf_dir).select("run_id", "equipment_id", "parameter", "candidate_id")


def p1_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return survivors.survivors(table(spark, sf_dir, "spec_candidates"), table(spark, sf_dir, "parameter_catalog"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return boilerplate.boilerplate(table(spark, sf_dir, "scraped_pages"))


def p2_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return boilerplate.bodies(table(spark, sf_dir, "scraped_pages"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.pairs(p3_nearest(spark, sf_dir))


def p3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return neighbors.nearest(table(spark, sf_dir, "document_chunks"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    items = splitting.items(table(spark, sf_dir, "scraped_pages"), table(spark, sf_dir, "document_chunks"))
    return splitting.oversized(items).where("piece_no = 0 and pieces > 1").select("item_kind", "item_id")


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return splitting.split_items(splitting.items(table(spark, sf_dir, "scraped_pages"), table(spark, sf_dir, "document_chunks")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return residue.residue(table(spark, sf_dir, "scraped_pages"))


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return residue.without_residue(table(spark, sf_dir, "scraped_pages"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    sources, results = table(spark, sf_dir, "data_sources"), table(spark, sf_dir, "search_results")
    place = F.when(F.col("batch_no") == 0, F.lit(0)).otherwise(F.col("id")).cast("bigint").alias("place")
    rows = sources.select(F.col("id").alias("record_id"), "url", "content_hash", place)
    none = F.lit(None).cast("string").alias("content_hash")
    history = sources.where("batch_no = 0").select(F.col("id").alias("record_id"), "url", none, F.lit(0).cast("bigint").alias("place"))
    found = results.select(F.col("seq").alias("record_id"), "url", none, F.col("seq").cast("bigint").alias("place"))
    kind = lambda df, k: df.select(F.lit(k).alias("record_kind"), F.col("record_id").cast("bigint").alias("record_id"))
    return kind(incremental.known(rows), "data_source").unionByName(kind(incremental.known(found, history), "search_result"))


def p7_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of p7_found by the persistent index: history first, then one batch after the other is probed and appended."""
    tune(spark)
    sources, results = table(spark, sf_dir, "data_sources"), table(spark, sf_dir, "search_results")
    none = F.lit(None).cast("string").alias("content_hash")
    history = sources.where("batch_no = 0")
    old = history.select(F.col("id").alias("record_id"), "url", "content_hash")
    found = None
    for kind, start, batches in (
        ("data_source", old, sources.where("batch_no > 0").select("batch_no", F.col("id").alias("record_id"), "url", "content_hash")),
        ("search_result", old.withColumn("content_hash", none), results.select("batch_no", F.col("seq").alias("record_id"), "url", none)),
    ):
        index = incremental.SegmentIndex(spark, f"{shared_dir(spark)}/segment-index-{uuid.uuid4().hex[:12]}")
        index.append(start)
        for (n,) in batches.select("batch_no").distinct().orderBy("batch_no").collect():  # one row a batch
            batch = batches.where(F.col("batch_no") == n).drop("batch_no")
            known = materialize(index.probe(batch).select(F.lit(kind).alias("record_kind"), F.col("record_id").cast("bigint").alias("record_id")), "known")
            index.append(batch)
            found = known if found is None else found.unionByName(known)
    return found


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return encoding.encode(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed documents with their copies, each with its source's target and reached share."""
    tune(spark)
    copies, shares = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    return copies.join(F.broadcast(shares.select("mix_name", "source", "target_share", "reached_share")), ["mix_name", "source"])


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return spans.shared_pairs(table(spark, sf_dir, "documents"))


def p10_portion(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return spans.shared_portion(table(spark, sf_dir, "documents"))


def p10_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without what stands in an earlier document, and the removed spans' original offsets."""
    tune(spark)
    return spans.without_repeats(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_survivors, p2_found, p2_bodies, p3_found, p3_nearest, p5_found, p5_pieces, p6_found, p6_clean, p7_found, p7_batches, p8_ids, p9_mix, p9_shares, p10_found, p10_portion, p10_kept)}
ORACLE_SQL: dict[str, str] = {
    "p5_found": """
        SELECT 'page' AS item_kind, CAST(page_id AS VARCHAR) AS item_id FROM scraped_pages WHERE length(text_content) > 4000
        UNION ALL SELECT 'chunk', chunk_id FROM document_chunks WHERE length(text) > 4000""",
}

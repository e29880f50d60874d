"""The warehouse: joins of brands, machines and facts, status, and idempotent writes.

Foreign keys are joins here: a cascade is a semi join, an insert-if-absent an anti join.
A table is a set of Parquet folders that a small manifest names; a write adds folders and
then puts a new manifest in the old one's place, so a reader sees the table before or after
a write and never in between.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def specs_frame(brands: DataFrame, equipment: DataFrame, specs: DataFrame) -> DataFrame:
    """Facts with their machine and brand, inner joins; the planner broadcasts the dimensions where their size allows it."""
    m = equipment.select(F.col("id").alias("equipment_id"), "brand_id", "model", "category", "equipment_type")
    b = brands.select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    return specs.join(m, "equipment_id").join(b, "brand_id").select("brand", "model", "category", "equipment_type", "parameter", "value", "unit", "confidence", "source_url", "extracted_at")


def curves_frame(brands: DataFrame, equipment: DataFrame, points: DataFrame) -> DataFrame:
    m = equipment.select(F.col("id").alias("equipment_id"), "brand_id", "model")
    b = brands.select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    return points.join(m, "equipment_id").join(b, "brand_id").select("brand", "model", "gear", "speed_kmh", "force_kn", "confidence")


def brand_table(equipment: DataFrame) -> DataFrame:
    """(id, name) of the brands that machines refer to."""
    return equipment.groupBy(F.col("brand_id").alias("id")).agg(F.min("brand").alias("name"))


def machines_named(names: DataFrame, brands: DataFrame, equipment: DataFrame) -> DataFrame:
    """(brand, model, equipment_id): the machines of names(brand, model) that the warehouse knows, each once."""
    b = brands.select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    m = equipment.select(F.col("id").alias("equipment_id"), "brand_id", "model").join(b, "brand_id").drop("brand_id")
    return names.select("brand", "model").distinct().join(m, ["brand", "model"])


def visited_urls(brands: DataFrame, equipment: DataFrame, sources: DataFrame, brand: str | None = None) -> DataFrame:
    """Distinct addresses of a brand's sources (by name or, where brands have one, key); of all brands without one."""
    b = brands if brand is None else brands.where((F.col("name") == brand) | ((F.col("key") == brand) if "key" in brands.columns else F.lit(False)))
    m = equipment.join(b.select(F.col("id").alias("brand_id")), "brand_id", "left_semi").select(F.col("id").alias("equipment_id"))
    return sources.join(m, "equipment_id", "left_semi").select("url").distinct()


def brand_status(brands: DataFrame, equipment: DataFrame, specs: DataFrame, sources: DataFrame) -> DataFrame:
    """Per brand: models, specs, sources and the last extraction; brands and machines without any count as zero. One pass for all brands."""
    ns = specs.groupBy("equipment_id").agg(F.count("*").alias("specs"), F.max("extracted_at").alias("last"))
    nu = sources.groupBy("equipment_id").agg(F.count("*").alias("sources"))
    m = equipment.select(F.col("id").alias("equipment_id"), "brand_id").join(ns, "equipment_id", "left").join(nu, "equipment_id", "left")
    g = m.groupBy("brand_id").agg(F.count("*").alias("models"), F.sum("specs").alias("specs"), F.sum("sources").alias("sources"), F.max("last").alias("last_extraction"))
    z = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return brands.select(F.col("id").alias("brand_id"), F.col("name").alias("brand")).join(g, "brand_id", "left").select("brand", z("models"), z("specs"), z("sources"), "last_extraction")


def model_counts(equipment: DataFrame, specs: DataFrame) -> DataFrame:
    """Specs of every machine, zero included, most first."""
    n = specs.groupBy(F.col("equipment_id").alias("id")).agg(F.count("*").alias("specs"))
    return equipment.select("id", "brand", "model").join(n, "id", "left").select("id", "brand", "model", F.coalesce("specs", F.lit(0)).cast("bigint").alias("specs")).orderBy(F.desc("specs"), "id")


def absent(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key isn't stored yet, one per key."""
    on = [new[k].eqNullSafe(stored[k]) for k in keys]
    return new.join(stored.select(*keys).distinct(), on, "left_anti").dropDuplicates(keys)


def with_ids(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Absent rows with ids that follow the stored ones; unique, not without gaps."""
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))  # one row
    return absent(new, stored, keys).crossJoin(top).withColumn("id", F.col("_top") + 1 + F.monotonically_increasing_id()).drop("_top")


def upsert(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows with the new ones in place of those of the same key."""
    on = [stored[k].eqNullSafe(new[k]) for k in keys]
    return stored.join(new.select(*keys).distinct(), on, "left_anti").unionByName(new, allowMissingColumns=True)


def clear_brand(brand_id: int, equipment: DataFrame, **children: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """What is left of each child table and of equipment without a brand's machines, and the counts that went: (table_name, removed)."""
    gone = equipment.where(F.col("brand_id") == brand_id).select(F.col("id").alias("equipment_id"))
    left = {name: t.join(gone, "equipment_id", "left_anti").select(*t.columns) for name, t in children.items()}
    left["equipment"] = equipment.where(F.coalesce(F.col("brand_id") != brand_id, F.lit(True)))
    counts = None
    for name, t in (*children.items(), ("equipment", equipment.select(F.col("id").alias("equipment_id")))):
        c = t.join(gone, "equipment_id", "left_semi").agg(F.count("*").alias("removed")).select(F.lit(name).alias("table_name"), "removed")
        counts = c if counts is None else counts.unionByName(c)
    return left, counts


class Warehouse:
    """Named tables under a folder.

    ``replace`` and ``append`` write one folder each. ``upsert`` keeps a table in ``BUCKETS``
    folders by the hash of its keys and writes only those that a batch falls into. Folders
    that no manifest names any more are left for readers of earlier manifests until
    ``vacuum``.
    """

    BUCKETS = 16
    SCHEMAS = {
        "brands": "id bigint, key string, name string, country string, site string, tier string, created_at timestamp",
        "equipment": "id bigint, brand_id bigint, model string, category string, equipment_type string, series string, created_at timestamp, updated_at timestamp",
        "technical_specs": "id bigint, equipment_id bigint, parameter string, value string, unit string, confidence double, source_url string, extracted_at timestamp",
        "data_sources": "id bigint, equipment_id bigint, url string, title string, source_type string, content_hash string, scraped_at timestamp, content_length bigint",
        "rimpull_points": "id bigint, equipment_id bigint, gear string, speed_kmh double, force_kn double, original_unit string, confidence double, source_url string, extracted_at timestamp",
        "search_log": "query string, engine string, results_count bigint, executed_at timestamp",
    }

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path, self._option = hadoop.Path, hadoop.Options.Rename
        self._fs = hadoop.Path(path).getFileSystem(conf)
        self._context = hadoop.FileContext.getFileContext(hadoop.Path(path).toUri() if ":" in path else hadoop.Path("file://" + path).toUri(), conf)

    def _at(self, *names: str):
        return self._path("/".join((self.path, *names)))

    def manifest(self, name: str) -> dict:
        """{"folders": [...], "buckets": {bucket: folder}, "keys": [...]} of a table; empty where there is none."""
        at = self._at(name, "manifest.json")
        if not self._fs.exists(at):
            return {}
        lines = self.spark.read.text(str(at.toString()), wholetext=True).collect()  # one small file
        return json.loads(lines[0].value)

    def _publish(self, name: str, manifest: dict) -> None:
        """The new manifest in the old one's place, in one step."""
        draft = self._at(name, f"manifest.{uuid.uuid4().hex[:8]}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._option, 1)
        options[0] = self._option.OVERWRITE
        self._context.rename(self._context.makeQualified(draft), self._context.makeQualified(self._at(name, "manifest.json")), options)

    def create(self) -> None:
        """Empty tables where there are none."""
        for name, schema in self.SCHEMAS.items():
            if not self.manifest(name):
                self.replace(name, self.spark.createDataFrame([], schema))

    def _folders(self, manifest: dict) -> list[str]:
        return [*manifest.get("folders", []), *manifest.get("buckets", {}).values()]

    def read(self, name: str) -> DataFrame:
        paths = [f"{self.path}/{name}/{f}" for f in self._folders(self.manifest(name))]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMAS[name])
        return self.spark.read.schema(self.SCHEMAS[name]).parquet(*paths) if name in self.SCHEMAS else self.spark.read.parquet(*paths)

    def _write(self, name: str, df: DataFrame) -> str:
        folder = f"v-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.path}/{name}/{folder}")  # a failure leaves the table as it was
        return folder

    def replace(self, name: str, df: DataFrame) -> None:
        self._publish(name, {"folders": [self._write(name, df)]})

    def append(self, name: str, df: DataFrame) -> None:
        old = self.manifest(name)
        self._publish(name, {**old, "folders": [*old.get("folders", []), self._write(name, df)]})

    def upsert(self, name: str, rows: DataFrame, keys: list[str]) -> int:
        """Rows in place of the stored ones of the same key; returns the number of buckets written. The first upsert by other keys writes all."""
        old = self.manifest(name)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.BUCKETS)).cast("int")
        stored = self.read(name)
        new = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
        sorted_in = old.get("keys") == keys and not old.get("folders")
        if sorted_in:  # only the buckets that the batch falls into
            hit = sorted(r.b for r in new.select(bucket.alias("b")).distinct().collect())  # a row a bucket at most
            paths = [f"{self.path}/{name}/{old['buckets'][str(b)]}" for b in hit if str(b) in old["buckets"]]
            stored = self.spark.read.schema(stored.schema).parquet(*paths) if paths else stored.where("false")
        merged = upsert(new, stored, keys).select(*stored.columns).withColumn("bucket", bucket)
        folder = f"v-{uuid.uuid4().hex[:12]}"
        merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}/{folder}")
        made = [str(f.getPath().getName()).removeprefix("bucket=") for f in self._fs.listStatus(self._at(name, folder)) if f.isDirectory()]
        kept = {k: v for k, v in old.get("buckets", {}).items() if sorted_in and int(k) not in hit}
        self._publish(name, {"buckets": {**kept, **{b: f"{folder}/bucket={b}" for b in made}}, "keys": keys})
        return len(made)

    def vacuum(self, name: str) -> int:
        """Delete the folders that the manifest doesn't name; their number."""
        named = {f.split("/")[0] for f in self._folders(self.manifest(name))}
        gone = [f.getPath() for f in self._fs.listStatus(self._at(name)) if f.isDirectory() and f.getPath().getName() not in named]
        for p in gone:
            self._fs.delete(p, True)
        return len(gone)

    def insert_absent(self, name: str, new: DataFrame, keys: list[str]) -> None:
        stored = self.read(name)
        rows = with_ids(new, stored, keys)
        self.append(name, rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns]))

    def clear_brand(self, brand_id: int) -> DataFrame:
        names = ("technical_specs", "data_sources", "rimpull_points")
        left, counts = clear_brand(brand_id, self.read("equipment"), **{n: self.read(n) for n in names})
        kept = self.spark.createDataFrame(counts.collect(), counts.schema)  # four rows
        for n in (*names, "equipment"):
            self.replace(n, left[n])
        return kept

    def backup(self, to: str) -> None:
        """A copy of every table, made by tasks."""
        for name in self.SCHEMAS:
            if self.manifest(name):
                self.read(name).write.mode("overwrite").parquet(f"{to.rstrip('/')}/{name}")

"""Command line: ``python -m tamarack.cli run|report|status|query|inventory|queries|clean|backup FOLDER``.

FOLDER is a folder of tables for status, report, query, inventory and queries, and a
warehouse for run, clean and backup, and for report and query with ``--store``.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from . import config, pipeline
from .operators import report, search, vectors, warehouse
from .session import build, table

COMMANDS = ("run", "report", "status", "query", "inventory", "queries", "clean", "backup")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tamarack")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("folder")
    p.add_argument("text", nargs="?", default="")
    p.add_argument("--brand", help="a brand's name or key")
    p.add_argument("--config", help="run: the folder of settings.yaml, brands.yaml and .env")
    p.add_argument("--offline", help="run: a folder with results.parquet and pages.parquet in place of the network")
    p.add_argument("--fresh", action="store_true", help="run: clear what is stored of the brands first")
    p.add_argument("--store", action="store_true", help="FOLDER is a warehouse")
    p.add_argument("--out", default="report")
    p.add_argument("-n", type=int, default=10)
    p.add_argument("--master", default="local[*]")
    a = p.parse_args(argv)
    spark = build(a.master)
    if a.command in ("run", "clean", "backup") or a.store:
        return _on_store(spark, a)
    equipment, specs = table(spark, a.folder, "equipment"), table(spark, a.folder, "technical_specs")
    brands = warehouse.brand_table(equipment)
    if a.brand and not brands.where(F.col("name") == a.brand).head(1):
        print(f"unknown brand: {a.brand}", file=sys.stderr)
        return 2
    if a.command == "status":
        s = warehouse.brand_status(brands, equipment, specs, table(spark, a.folder, "data_sources"))
        (s.where(F.col("brand") == a.brand) if a.brand else s).orderBy(F.desc("specs")).show(1000, False)
    elif a.command == "report":
        frame = warehouse.specs_frame(brands, equipment, specs)
        points = report.series(warehouse.curves_frame(brands, equipment, table(spark, a.folder, "rimpull_points")))
        if a.brand:
            frame, points = frame.where(F.col("brand") == a.brand), points.where(F.col("brand") == a.brand)
        report.write_csv(frame, a.out)
        with open(f"{a.out}/summary.json", "w", encoding="utf-8") as f:
            f.write(report.summary_json(frame))
        print(report.html_report(frame, f"{a.out}/report.html", points=points))
    elif a.command == "inventory":
        search.inventory(equipment).orderBy("level", "brand", "category", "equipment_type").show(1000, False)
        if "tier" in equipment.columns:
            report.write_inventory(equipment, f"{a.out}/inventory")
    elif a.command == "queries":
        search.queries(equipment.select("brand", "model", "equipment_type")).select("query").show(a.n, False)
    else:
        encode = vectors.hashing_encoder()
        chunks = encode(table(spark, a.folder, "document_chunks").drop("embedding"))
        vectors.shown(vectors.search_text(chunks, a.text, encode, a.n, a.brand)).show(a.n, 80)
    return 0


def _on_store(spark, a) -> int:
    store = warehouse.Warehouse(spark, a.folder)
    name = a.brand
    if a.command == "run":
        folder = a.config or "config"
        settings = config.load_settings(folder) if os.path.exists(f"{folder}/settings.yaml") else config.settings({})
        keys, open_to_all = config.load_env(f"{folder}/.env")
        if open_to_all:
            print("others can read the file of keys", file=sys.stderr)
        machines = search.models(search.brands(spark, config.check_brands(config.load_yaml(folder, "brands.yaml"))))
        machines = machines.select(F.col("name").alias("brand"), "key", "model", "equipment_type", "tier", "category")
        find, fetch = pipeline.stored(table(spark, a.offline, "results"), table(spark, a.offline, "pages")) if a.offline else pipeline.online(spark, settings, keys)
        try:
            totals = pipeline.run(spark, a.folder, machines, find, fetch, settings, a.brand, a.fresh, a.out)
        except ValueError as e:
            print(e, file=sys.stderr)
            return 2
        print(", ".join(f"{k} {v}" for k, v in totals.items()))
        return 0
    if name is not None:
        known = store.read("brands").where((F.col("name") == name) | (F.col("key") == name)).select("id", "name").head(1)
        if not known:
            print(f"unknown brand: {name}", file=sys.stderr)
            return 2
        name = known[0].name
    if a.command == "clean":
        if name is None:
            print("clean needs a brand", file=sys.stderr)
            return 2
        store.clear_brand(known[0].id).show()
    elif a.command == "backup":
        store.backup(a.out)
    elif a.command == "report":
        print(pipeline.reported(store, a.out, name))
    elif a.command == "status":
        s = warehouse.brand_status(store.read("brands"), store.read("equipment"), store.read("technical_specs"), store.read("data_sources"))
        (s.where(F.col("brand") == name) if name else s).orderBy(F.desc("specs")).show(1000, False)
    elif a.command == "query":
        encode = vectors.hashing_encoder()
        stored = spark.read.parquet(f"{a.folder.rstrip('/')}/vectors")
        vectors.shown(vectors.search_text(stored, a.text, encode, a.n, name)).show(a.n, 80)
    else:
        print(f"{a.command} needs a folder of tables", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())

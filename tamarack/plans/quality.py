"""Queries of the core operators for training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import units
from ..session import table, tune


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    records = units.spec_records(table(spark, sf_dir, "technical_specs")).unionByName(units.point_records(table(spark, sf_dir, "rimpull_points")))
    return units.not_common(records, table(spark, sf_dir, "parameter_catalog"))


def p4_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    records = units.spec_records(table(spark, sf_dir, "technical_specs")).unionByName(units.point_records(table(spark, sf_dir, "rimpull_points")))
    return units.normalize_units(records, table(spark, sf_dir, "parameter_catalog"))


QUERIES = {"p4_found": p4_found, "p4_normalized": p4_normalized}

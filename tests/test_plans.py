import os

import pytest

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().toString()


def test_every_query_has_rows_and_named_columns(spark):
    import __spark_entry__ as entry

    found, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(found)
    assert entry.entry(spark).count() > 0


def test_joins_with_dimensions_are_broadcast_and_columns_pruned(spark):
    from tamarack.plans import reference

    p = plan(reference.QUERIES["specs_join"](spark, DIR))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    p = plan(reference.QUERIES["conf_band"](spark, DIR))
    assert "ReadSchema: struct<id:bigint,confidence:double>" in p


def test_extraction_stays_in_the_jvm(spark):
    from tamarack.plans import reference

    for name in ("text_specs", "table_specs", "consensus_specs", "curve_consensus", "url_classify", "url_safe", "chunk_documents"):
        p = plan(reference.QUERIES[name](spark, DIR))
        assert "Python" not in p and "InPandas" not in p and "Arrow" not in p, name


def test_filters_reach_the_scan(spark):
    from tamarack.operators import report
    from tamarack.session import table

    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    p = plan(report.filtered(table(spark, DIR, "spec_candidates"), brand="Dravex Earthmoving", least=0.5))
    assert "PushedFilters: [" in p and "EqualTo(brand,Dravex Earthmoving)" in p

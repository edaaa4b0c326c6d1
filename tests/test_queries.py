"""Every registered query against its expected result, on the smallest tables."""

import os

import pytest
from oracle_check import difference

from __spark_entry__ import entry, oracle_sql, queries
from wardgrid.plans.oracles import ORACLES
from wardgrid.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert difference(spark, SF_DIR, name, queries()[name], oracle_sql()[name]) is None


@needs_tables
def test_entry(spark):
    assert entry(spark).columns == ["geoid", "ntaname", "crashes", "pop", "crashes_per_1k"]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_spatial_reports_compare_no_pairs(spark):
    plan = final_plan(queries()["crashes_per_tract"](spark, SF_DIR))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastHashJoin" in plan and "TakeOrderedAndProject" in plan


@needs_tables
def test_beyond_the_limit_the_pieces_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()["tract_matches_salted"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_cell" in plan and "NestedLoop" not in plan


@needs_tables
def test_month_filters_prune_folders(spark):
    plan = queries()["partitioned_scan"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


@needs_tables
def test_a_line_is_parsed_once_however_many_fields_are_filtered(spark):
    df = queries()["busiest_stations"](spark, SF_DIR)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parse_json") + \
        df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") <= 1

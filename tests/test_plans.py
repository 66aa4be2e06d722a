"""Plan shapes that matter at scale, for every catalogue query."""

from __future__ import annotations

import os
import re

import pytest

from panelloom.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables are absent")
# Only text leaves the JVM, and only for what Spark has no function for.
PYTHON = {
    "html_to_text", "fast_strip", "filing_text", "preprocess_text", "standardized_documents",
    "features_from_files", "preprocess_wide_text", "bundled_documents",
}


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_needless_python(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert ("ArrowEvalPython" in plan) == (name in PYTHON)
    assert "BatchEvalPython" not in plan


def read_columns(plan):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("firm_year_attention", {"doc_id", "text", "source"}),
        ("bulk_resolve", {"o_orderkey", "o_custkey", "c_custkey", "c_mktsegment", "c_acctbal", "c_name"}),
        ("to_firm_year", {"o_orderkey", "o_orderdate"}),
        ("qc_report", {"o_custkey", "o_orderdate", "o_orderpriority"}),
        ("panel_outer", {"o_custkey", "o_orderdate", "o_totalprice", "l_suppkey", "l_shipdate",
                         "l_quantity", "l_partkey"}),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    assert set().union(*read_columns(plan_of(spark, name))) <= columns


def test_roll_up_combines_before_its_only_keyed_shuffle(spark):
    plan = plan_of(spark, "firm_year_attention")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan


def test_path_listing_reads_no_content(spark):
    """Of the scans that find the files, only one reads the pages' markup."""
    plan = plan_of(spark, "standardized_documents")
    assert sum("html" in columns for columns in read_columns(plan)) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_round_robin_shuffle(spark, name):
    """Rows are dealt anew by request only (``spark.panelloom.scanTasks``)."""
    assert "RoundRobin" not in plan_of(spark, name)


def test_building_a_panel_of_unique_tables_runs_no_job(spark):
    from panelloom.operators import panel

    grouped = spark.range(100).selectExpr("cast(id % 7 AS string) AS firm_id", "2020 AS year", "id AS n")
    grouped = grouped.groupBy("firm_id", "year").sum("n").withColumnRenamed("sum(n)", "n")
    spark.sparkContext.setJobGroup("panel-build", "building")
    panel.assemble_panel(spark, {"a": grouped, "b": grouped}, unique_keys=True)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("panel-build") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sample_moves_ids_only(spark):
    plan = plan_of(spark, "stratified_sample")
    assert "excerpt" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and "SinglePartition" not in "".join(windows)


def test_files_are_found_in_one_join(spark):
    plan = plan_of(spark, "standardized_documents")
    assert plan.count("Join") == 2  # paths to manifest rows, records to texts


def test_sql_panel_reads_each_table_once(spark):
    plan = plan_of(spark, "panel_sql")
    assert plan.count("FileScan") == 2 and plan.count("FullOuter") == 1


def test_three_tables_share_one_shuffle(spark):
    """One exchange for each input's own aggregate and one for the panel."""
    plan = plan_of(spark, "panel_outer")
    assert plan.count("Exchange hashpartitioning") == 4 and "Join" not in plan

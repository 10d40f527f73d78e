"""Plan guards over every registered query of the library's own: skew-safe and distributed.

* no window function (it would put a whole key in one task), no cartesian product and no
  nested-loop join;
* every shuffle aggregation is preceded by its partial (map-side) aggregation;
* joins of file rows with per-file facts never broadcast the rows;
* ``last`` over numbers is a hash aggregation, and a range reaches the scan.
"""

import re

import pytest

import __spark_entry__ as E
from heliolake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = sorted(QUERIES)
FILES = [n for n in BATCH if n.startswith(("csv_", "json", "text_source", "folder_", "file_"))]


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_window_cartesian_or_nested_loop(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"\bWindow(GroupLimit)?\b", plan), plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


@pytest.mark.parametrize("name", ["window_last", "window_mean", "upsert_latest", "key_age", "footer_sum",
                                  "last_not_null", "coerce_reject", "status_and_thresholds"])
def test_aggregations_combine_map_side(spark, name):
    plan = _plan(spark, name)
    finals = re.findall(r"(?:Hash|Sort|ObjectHash)Aggregate\(keys?=\[[^\]]*\], functions=\[(?!partial_)", plan)
    partials = re.findall(r"functions=\[partial_", plan)
    assert finals and len(partials) >= len(finals), plan


def test_dimension_lookup_broadcasts_by_measured_size(spark):
    assert "BroadcastHashJoin" in _plan(spark, "dimension_lookup")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(spark, "dimension_lookup")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", FILES)
def test_file_rows_are_never_the_broadcast_side(spark, name):
    assert "BuildLeft" not in _plan(spark, name)


@pytest.mark.parametrize("name", ["window_last", "window_cut_range", "multi_yield"])
def test_last_is_a_hash_aggregation(spark, name):
    assert "SortAggregate" not in _plan(spark, name)


def test_range_reaches_the_scan(spark):
    plan = _plan(spark, "window_cut_range")
    scans = re.findall(r"FileScan parquet \[[^\]]*event_type[^\n]*", plan)
    assert scans and all("DataFilters: [isnotnull(ts" in s or "Subquery" in s or "scalar-subquery" in s for s in scans), scans


def test_every_query_has_an_oracle():
    assert all(q.oracle for q in QUERIES.values())

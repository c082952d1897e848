"""Physical plans: no full sort in one task, pruned scans, no joins where none are needed."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark import catalog

FOLDER = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw_single_partition(plan):
    """Single-task exchanges whose input was not aggregated first."""
    lines = plan.splitlines()
    return [
        line
        for line, below in zip(lines, lines[1:])
        if "Exchange SinglePartition" in line and "Aggregate" not in below and "Sort" not in below
    ]


@pytest.mark.parametrize("name", ["pv_uv_tumble", "topn_slide", "most_active_user", "watermark_annotate", "running_leader", "union_watermark"])
def test_no_raw_rows_in_one_task(spark, name):
    assert raw_single_partition(plan_of(catalog.QUERIES[name](spark, FOLDER))) == []


def test_top_n_is_cut_before_the_shuffle(spark):
    plan = plan_of(catalog.QUERIES["topn_slide"](spark, FOLDER))
    assert plan.count("WindowGroupLimit") == 2 and "Expand" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(catalog.QUERIES["sql_select"](spark, FOLDER))
    assert "EqualTo(event_type,click)" in plan
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_type:string>", plan)


def test_classify_does_not_shuffle_rows(spark):
    plan = plan_of(catalog.QUERIES["late_classify"](spark, FOLDER))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_scan_needs_one_shuffle_of_rows_and_no_join(spark):
    plan = plan_of(catalog.QUERIES["watermark_annotate"](spark, FOLDER))
    assert "Join" not in plan
    assert plan.count("REPARTITION_BY_NUM") == 1

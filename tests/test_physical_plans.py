"""The plans that must hold at scale: what is pushed down, shuffled and broadcast."""

import re

import pytest

import __spark_entry__ as entry
from tablevault import (
    diff_rows,
    diff_rows_in_suspect_buckets,
    fingerprint,
    positive_ids,
    profile,
    row_count,
    sample_rows,
)

SF = "/root/testdata/sf0.001"
BUILT_ONLY = [
    "filter_positive_id", "filter_malformed_id", "row_counts", "sample_1000", "backup_order",
    "load_plan", "due_check", "due_tables", "retention_days", "expired_backups",
    "storage_location", "diff_rows", "diff_rows_in_suspect_buckets", "sample_diff", "profile",
    "profile_diff",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_the_id_filter_reaches_the_scan(lineitem):
    plan = plan_of(positive_ids(lineitem.select("l_orderkey"), "l_orderkey"))
    assert "GreaterThan(l_orderkey,0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "Exchange" not in plan


def test_a_count_reads_no_columns(lineitem):
    assert "ReadSchema: struct<>" in plan_of(row_count(lineitem, "t"))


def test_fingerprint_and_profile_shuffle_no_rows(lineitem):
    for df in (fingerprint(lineitem), profile(lineitem)):
        plan = plan_of(df)
        assert re.findall(r"Exchange (\w+)", plan) == ["SinglePartition"]
        assert "partial_sum" in plan


def test_the_diff_adds_up_copies_before_its_one_shuffle(lineitem):
    plan = plan_of(diff_rows(lineitem, lineitem))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan.split("Exchange hashpartitioning")[1]
    assert "SortAggregate" not in plan


def test_only_the_suspect_list_is_broadcast(lineitem):
    plan = plan_of(diff_rows_in_suspect_buckets(lineitem, lineitem))
    assert plan.count("BroadcastExchange HashedRelationBroadcastMode(List(input[0, bigint") == 2
    assert plan.count("BroadcastExchange") == 2


def test_a_sample_is_no_full_sort(lineitem):
    plan = plan_of(sample_rows(lineitem, 1000))
    assert "TakeOrderedAndProject" in plan
    assert "Exchange rangepartitioning" not in plan


@pytest.mark.parametrize("name", BUILT_ONLY)
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert bad not in plan


def test_joins_of_registry_and_log_do_not_rely_on_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("due_check", "expired_backups", "backup_order"):
            plan = plan_of(entry.queries()[name](spark, SF))
            assert "BroadcastExchange" not in plan
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

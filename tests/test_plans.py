"""Physical plans at scale: broadcast joins are switched off, as they would be
for tables past the size threshold."""

import re

import pytest

from trolley.operators import joins
from trolley.plans import explore, features
from trolley.registry import QUERIES
from trolley.workspace import workspace

SF = "/root/testdata/sf0.001"


@pytest.fixture
def ws(spark):
    space = workspace(spark, SF)
    _ = space.matrix
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield space
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (hash|range)partitioning", plan(df)))


def test_order_joins_and_groupings_read_buckets(ws):
    assert shuffles(joins.prior_detail(ws.tables)) == 0
    assert shuffles(joins.train_with_user(ws.tables)) == 0
    assert shuffles(explore.orders_reorder_mean(ws.tables)) == 0


def test_pairs_shuffle_once(ws):
    assert shuffles(features.user_product_features(ws.tables)) == 1


def test_matrix_joins_users_without_shuffling_pairs(ws):
    built = features.feature_matrix(ws.spark, ws.tables, ws.store)
    lines = plan(built).splitlines()
    moved = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line]
    # the two order-level inputs of the user statistics, read from orders
    assert len(moved) == 2
    for i in moved:
        scan = next(line for line in lines[i:] if "FileScan" in line)
        assert "_orders_" in scan
    assert all("SelectedBucketsCount" in line for line in lines if "_pairs_" in line)


def test_columns_and_filters_reach_the_scan(ws):
    text = plan(explore.orders_by_number(ws.tables))
    assert "ReadSchema: struct<eval_set:string,order_number:int>" in text
    assert "EqualTo(eval_set,prior)" in text
    lines = plan(explore.popularity_reorder(ws.tables))
    assert "PartitionFilters: [isnotnull(eval_set" in lines
    assert "ReadSchema: struct<product_id:int,reordered:int>" in lines


@pytest.mark.parametrize("name", ["train_matrix", "test_matrix"])
def test_split_prunes_folders(ws, name):
    assert re.search(r"PartitionFilters: \[.*eval_set", plan(QUERIES[name](ws.spark, SF)))


def test_no_product_of_tables(ws):
    from trolley.registry_sql import SQL

    for name in SQL:
        text = plan(QUERIES[name](ws.spark, SF))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name

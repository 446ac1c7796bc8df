"""The routes taken for hot groups give the same rows as the plain ones."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trolley.functions.stats import GroupFunction
from trolley.operators import groups, ranking
from trolley.plans import features
from trolley.sources import Store, fixtures
from trolley.workspace import workspace


@pytest.fixture(scope="module")
def ws(spark):
    return workspace(spark, "/root/testdata/sf0.001")


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = a.select(cols), b.select(cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def hot_rows(spark, n=600):
    """One key holds most rows."""
    rng = random.Random(7)
    data = [(1 if rng.random() < 0.7 else rng.randrange(2, 9), i) for i in range(n)]
    return spark.createDataFrame(data, "k int, at int")


@pytest.mark.parametrize("descending", [False, True])
def test_blocks_do_not_change_positions(spark, descending):
    df = hot_rows(spark)
    blocks = {"_b": F.floor(F.col("at") / 16)}
    plain = ranking.position_in_group(df, ["k"], ["at"], descending=descending, size="n")
    cut = ranking.position_in_group(
        df, ["k"], ["at"], blocks, descending=descending, size="n"
    )
    same(plain, cut)


def test_blocks_carry_the_previous_value(spark):
    df = hot_rows(spark)
    blocks = {"_b": F.floor(F.col("at") / 5)}
    plain = ranking.position_in_group(df, ["k"], ["at"], previous=("at", "before"))
    cut = ranking.position_in_group(df, ["k"], ["at"], blocks, previous=("at", "before"))
    same(plain, cut)


def test_range_blocks_number_a_hot_key(spark):
    df = hot_rows(spark)
    ranged = ranking.range_blocks(df, ["k", "at"], Store(spark))
    assert ranged.filter("k = 1").select("_block").distinct().count() > 1
    got = ranking.position_in_group(ranged, ["k"], ["at"], {"_block": F.col("_block")})
    same(got, ranking.position_in_group(df, ["k"], ["at"]))


def test_quantiles_of_large_groups(spark):
    rng = random.Random(3)
    data = [(1 if rng.random() < 0.7 else 2, rng.randrange(50) / 4) for _ in range(500)]
    df = spark.createDataFrame(data + [(3, 1.0), (3, None)], "k int, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = ranking.group_quantiles(df, ["k"], "v", probs).orderBy("k").collect()
    for row in got:
        values = [v for k, v in [*data, (3, 1.0)] if k == row["k"]]
        assert row["count"] == len(values)
        assert row["mean"] == pytest.approx(sum(values) / len(values))
        assert row["quantiles"] == pytest.approx(np.quantile(values, probs).tolist())


def test_join_with_an_aggregate_on_a_hot_key_is_split(spark):
    """With the statistics joined back, the rows of a hot key are split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).cast("int")
        df = spark.range(0, 400_000, 1, 16).select(key.alias("k"), F.xxhash64("id").alias("v"))
        joined = groups.group_stats_multi(df, ["k"], {"v": {"n": "count", "most": "max"}}, only_new=False)
        assert len(joined.collect()) == 400_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_functions_of_the_caller_beside_built_in_ones(spark):
    largest = GroupFunction(
        "two_largest",
        lambda v: np.sort(np.append(v, [-np.inf, -np.inf]))[-2:],
        lambda states: np.sort(states.ravel())[-2:],
        lambda state: state[0] if np.isfinite(state[0]) else state[1],
    )
    rng = random.Random(5)
    data = [(1 if rng.random() < 0.7 else rng.randrange(2, 40), rng.random()) for _ in range(5000)]
    df = spark.createDataFrame([*data, (50, None), (None, 9.0)], "k int, v double").repartition(7)
    got = groups.group_stats_multi(df, ["k"], {"v": {"n": "count", "second": largest, "mid": "median", "top": "max"}})
    for row in got.collect():
        values = sorted(v for k, v in data if k == row["k"])
        if row["k"] == 50:
            assert (row["n"], row["second"]) == (0, None)
        else:
            assert (row["n"], row["second"], row["top"]) == (len(values), values[-2], values[-1])


def test_ordinals_and_streaks_in_blocks(ws):
    same(features.purchase_ordinal(ws.tables, width=3), features.purchase_ordinal(ws.tables))
    same(features.order_streaks(ws.tables, width=3), features.order_streaks(ws.tables))


def plainly_numbered(orders):
    """Number, eval set and previous day of each order by one window a customer."""
    along = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    last = Window.partitionBy("o_custkey")
    number, size = F.row_number().over(along), F.count("*").over(last)
    gap = F.datediff(F.to_date("o_orderdate"), F.lag(F.to_date("o_orderdate")).over(along)) % 31
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        number.cast("int").alias("order_number"),
        (number < size).alias("prior"),
        gap.cast("double").alias("gap"),
    )


def numbered(orders):
    placed = fixtures.numbered_orders(orders)
    return placed.select(
        "order_id",
        "order_number",
        (F.col("eval_set") == "prior").alias("prior"),
        F.col("days_since_prior_order").alias("gap"),
    )


def test_every_customer_is_numbered(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert fixtures.numbered_orders(orders).count() == orders.count()
    same(numbered(orders), plainly_numbered(orders))


def test_numbers_follow_the_time_of_day(spark):
    at = dt.datetime(1996, 1, 1)
    data = [(1 << 25, 1), (5, 2), ((1 << 24) + 1, 3), (7, 3), (6, 30)]
    orders = spark.createDataFrame(
        [(key, 1, at + dt.timedelta(hours=h)) for key, h in data],
        "o_orderkey long, o_custkey long, o_orderdate timestamp",
    )
    same(numbered(orders), plainly_numbered(orders))
    got = {r.order_id: r.order_number for r in numbered(orders).collect()}
    assert got == {1 << 25: 1, 5: 2, 7: 3, (1 << 24) + 1: 4, 6: 5}


def test_one_customer_with_a_third_of_all_orders(spark):
    day = dt.datetime(1996, 1, 1)
    rng = random.Random(5)
    data = [
        (i, 0 if rng.random() < 0.34 else 1 + rng.randrange(40), day + dt.timedelta(hours=rng.randrange(2000)))
        for i in range(1500)
    ]
    orders = spark.createDataFrame(data, "o_orderkey long, o_custkey long, o_orderdate timestamp")
    same(numbered(orders), plainly_numbered(orders))


def test_every_line_finds_its_product(spark, ws):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    sold = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    assert sold.count() == lines.count()
    assert ws.tables["products"].count() == parts.select("p_brand", "p_type").distinct().count()
    kinds = sold.select("l_orderkey", "p_brand", "p_type").distinct()
    last = ws.tables["orders"].filter("eval_set = 'test'").select(F.col("order_id").alias("l_orderkey"))
    kept = ws.tables["prior"].count() + ws.tables["train"].count()
    assert kept == kinds.join(last, "l_orderkey", "left_anti").count()


def test_literal_and_rewritten_product_counts(ws):
    """Counts taken from the pairs equal those of a rank over the lines."""
    literal = features.purchase_ordinal(ws.tables).groupBy("product_id").agg(
        F.count("user_id").alias("_prod_tot_cnts"),
        F.count_if(F.col("_user_buy_product_times") == 1).alias("_prod_buy_first_time_total_cnt"),
        F.count_if(F.col("_user_buy_product_times") == 2).alias("_prod_buy_second_time_total_cnt"),
    )
    pairs = features.pair_stats(features.prior_detail(ws.tables))
    same(features.product_features(pairs).select(literal.columns), literal)


def test_own_functions_meet_small_groups_in_few_calls(spark):
    """No grouped Python call per group: states are merged as sorted rows stream by."""
    total = GroupFunction("total", lambda v: [v.sum(), len(v)], lambda s: s.sum(axis=0), lambda s: s[0] / s[1])
    df = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("k"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("s"), F.col("id").cast("int").alias("v")
    ).repartition(5)
    got = total.over_groups(df, ["k", "s"], "v", "m")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan
    want = df.groupBy("k", "s").agg(F.avg("v").alias("m"))
    assert got.count() == 20_000
    same(got, want)


def test_a_group_longer_than_a_batch_is_merged_across_batches(spark, monkeypatch):
    from trolley.functions import stats

    monkeypatch.setattr(stats, "HELD_NUMBERS", 3)
    keep = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        top = GroupFunction("top", lambda v: [v.max()], lambda s: s.max(axis=0), lambda s: s[0])
        got = top.over_groups(hot_rows(spark, 200), ["k"], "at", "top").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", keep)
    want = hot_rows(spark, 200).groupBy("k").agg(F.max("at").cast("double").alias("top")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))

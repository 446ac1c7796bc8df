"""Micro tables for the semantics that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from trolley.functions import cap, name_flag, ratio
from trolley.operators import decode, encode, groups, matrix_ops, metrics, ranking, segments
from trolley.plans import explore, features
from trolley.sources import Store


def rows(df):
    return sorted(tuple(r) for r in df.collect())


ORDERS = (
    "order_id int, user_id long, eval_set string, order_number int, order_dow int,"
    " order_hour_of_day int, days_since_prior_order double"
)
LINES = "order_id int, product_id int, add_to_cart_order int, reordered int"


def baskets(spark, orders, prior=(), train=()):
    return {
        "orders": spark.createDataFrame(list(orders), ORDERS),
        "prior": spark.createDataFrame(list(prior), LINES),
        "train": spark.createDataFrame(list(train), LINES),
    }


def test_top_n_keeps_or_breaks_ties(spark):
    sold = spark.createDataFrame(
        [("a", 9), ("b", 5), ("c", 5), ("d", 1)], "name string, n int"
    )
    assert rows(ranking.top_n(sold, "n", 2)) == [("a", 9), ("b", 5), ("c", 5)]
    assert rows(ranking.top_n(sold, "n", 2, ties=False, tiebreak=["name"])) == [
        ("a", 9),
        ("b", 5),
    ]
    assert rows(ranking.top_n(sold, "n", 9)) == rows(sold)


def test_missing_gap_is_dropped_or_kept(spark):
    tables = baskets(
        spark,
        [(1, 1, "prior", 1, 0, 0, None), (2, 1, "prior", 2, 0, 0, 7.0), (3, 1, "train", 3, 0, 0, 7.0)],
    )
    assert rows(explore.days_gap_hist(tables)) == [(7.0, 2)]
    kept = {r[0]: r[1] for r in explore.days_gap_hist(tables, keep_null=True).collect()}
    assert kept == {None: 1, 7.0: 2}


def test_purchase_ordinal_follows_order_number(spark):
    tables = baskets(
        spark,
        [(30, 1, "prior", 1, 0, 0, None), (10, 1, "prior", 2, 0, 0, 1.0), (20, 1, "prior", 3, 0, 0, 1.0)],
        [(10, 7, 1, 1), (20, 7, 1, 1), (30, 7, 1, 0)],
    )
    ordinal = features.purchase_ordinal(tables)
    assert rows(ordinal.select("order_number", "_user_buy_product_times")) == [
        (1, 1), (2, 2), (3, 3),
    ]


def test_share_is_within_product(spark):
    cells = spark.createDataFrame(
        [(1, 1, 3), (1, 2, 1), (2, 1, 1), (2, 2, 1)], "product_id int, pos int, count int"
    )
    got = ranking.share(cells, "count", within=["product_id"])
    assert rows(got.select("product_id", "pos", "proportion")) == [
        (1, 1, 0.75), (1, 2, 0.25), (2, 1, 0.5), (2, 2, 0.5),
    ]
    whole = ranking.share(cells, "count").agg(F.sum("proportion")).first()[0]
    assert whole == pytest.approx(1.0)


def lists(spark, *data):
    return spark.createDataFrame(list(data), "order_id int, products string")


def test_none_is_an_item(spark):
    truth = lists(spark, (1, "None"), (2, "None"), (3, "4 5"))
    pred = lists(spark, (1, "None"), (2, "4"), (3, "5 4"), (9, "4"))
    assert rows(metrics.order_f1(truth, pred)) == [(1, 1.0), (2, 0.0), (3, 1.0)]
    assert metrics.mean_f1(truth, pred).first()[0] == pytest.approx(2 / 3)


def test_repeated_id_lowers_list_f1_only(spark):
    truth, pred = lists(spark, (1, "4")), lists(spark, (1, "4 4"))
    assert metrics.mean_f1(truth, pred).first()[0] == pytest.approx(2 / 3)
    assert metrics.mean_f1_sets(truth, pred).first()[0] == 1.0


def test_unmatched_order_counts_in_denominator(spark):
    orders = [(i, 1, "prior", i, 0, 0, 1.0) for i in (1, 2, 3, 4)]
    tables = baskets(spark, orders, [(3, 7, 1, 1)])
    means = explore.orders_reorder_mean(tables)
    assert rows(means.select("order_id", "m").fillna(-1.0)) == [(3, 1.0), (4, -1.0)]
    assert explore.always_reorder_users(tables).count() == 0
    assert rows(explore.always_reorder_users(tables, 0.5)) == [(1, 1, 0.5)]


def test_cluster_mean_counts_absent_buyers(spark):
    counts = spark.createDataFrame(
        [(1, "a", 4), (2, "b", 2)], "user_id int, aisle string, n int"
    )
    members = spark.createDataFrame([(1, 0), (2, 0)], "user_id int, segment int")
    assert rows(segments.cluster_profile(counts, members)) == [(0, "a", 2.0), (0, "b", 1.0)]
    assert rows(segments.user_aisle_crosstab(counts)) == [
        (1, "a", 4), (1, "b", 0), (2, "a", 0), (2, "b", 2),
    ]


def test_aisles_of_one_name_count_together(spark):
    tables = baskets(
        spark,
        [(1, 7, "prior", 1, 0, 0, None)],
        [(1, 10, 1, 0), (1, 11, 2, 0), (1, 12, 3, 0), (1, 13, 4, 0)],
    )
    tables["products"] = spark.createDataFrame(
        [(10, "w", 1, 1), (11, "x", 2, 1), (12, "y", 3, 1), (13, "z", 9, 1)],
        "product_id int, product_name string, aisle_id int, department_id int",
    )
    tables["aisles"] = spark.createDataFrame(
        [(1, "milk"), (2, "tea"), (3, "milk")], "aisle_id int, aisle string"
    )
    assert rows(segments.user_aisle_counts(tables)) == [(7, "milk", 2), (7, "tea", 1)]


def test_codes_follow_numeric_order(spark):
    df = spark.createDataFrame([(10,), (2,), (1,), (2,), (None,)], "v int")
    got = encode.encode_labels(df, ["v"], Store(spark))
    assert sorted(r[0] for r in got.collect() if r[0] is not None) == [0, 1, 1, 2]
    words = spark.createDataFrame([("b",), ("a",), ("ab",)], "w string")
    codes = encode.label_codes(words, "w", Store(spark))
    assert rows(codes) == [("a", 0), ("ab", 1), ("b", 2)]


def test_narrowing_bounds(spark):
    df = spark.createDataFrame(
        [(0, 0, 0, 0, -1), (127, 128, 32767, 32768, 5)],
        "a long, b long, c long, d long, e long",
    )
    narrow, report = encode.narrow_ints(df)
    assert [f.dataType.simpleString() for f in narrow.schema] == [
        "tinyint", "smallint", "smallint", "int", "bigint",
    ]
    assert {r["column"]: r["adjusted"] for r in report.collect()}["e"] is False
    assert rows(narrow) == rows(df)


def test_basket_size_is_largest_position(spark):
    tables = baskets(
        spark,
        [(1, 1, "prior", 1, 0, 0, None)],
        [(1, 5, 3, 0), (1, 6, 1, 0), (1, 7, 2, 0)],
        [(2, 5, 1, 0)],
    )
    assert rows(explore.basket_size_hist(tables)) == [(1, 1, "train"), (3, 1, "prior")]


def test_cleaning_keeps_negatives(spark):
    df = spark.createDataFrame(
        [(1.0, 1), (2.0, None), (float("inf"), None), (float("nan"), 1), (None, 1)],
        "f double, reordered int",
    )
    assert rows(matrix_ops.clean_matrix(df, ["f"], "reordered")) == [(1.0, 1), (2.0, 0)]


def test_two_keys_are_kept(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 5)], "a int, b int, v int")
    got = groups.group_stats_single(df, ["a", "b"], ["v"], ["mean", "max"])
    assert got.columns == ["a", "b", "_ab_mean_by_v", "_ab_max_by_v"]
    assert rows(got) == [(1, 2, 4.0, 5)]


def test_group_stats_arguments(spark):
    df = spark.createDataFrame([(1, 2), (None, 4)], "a int, v int")
    with pytest.raises(TypeError):
        groups.group_stats_multi(df, "a", {"v": {"m": "max"}})
    with pytest.raises(TypeError):
        groups.group_stats_single(df, ["a"], "v", ["max"])
    with pytest.raises(ValueError):
        groups.group_stats_single(df, ["a"], ["v"], ["mode"])
    assert rows(groups.group_stats_multi(df, ["a"], {"v": {"m": "max"}})) == [(1, 2)]
    back = groups.group_stats_multi(df, ["a"], {"v": {"m": "median"}}, only_new=False)
    assert {r["v"]: r["m"] for r in back.collect()} == {2: 2.0, 4: None}


def test_division_is_real_and_safe(spark):
    df = spark.createDataFrame([(1, 2), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [0.5, None]


def test_lists_sort_as_numbers(spark):
    scored = spark.createDataFrame(
        [(1, 10, 0.9), (1, 9, 0.9), (1, 2, 0.1), (2, 3, 0.1)],
        "order_id int, product_id int, score double",
    )
    assert rows(decode.decode(scored, 0.5)) == [(1, "9 10")]
    assert rows(decode.complete_lists(scored, 0.5)) == [(1, "9 10"), (2, "None")]
    both = decode.submission(scored.select("order_id").distinct(), decode.decode(scored, 0.5))
    assert rows(both) == [(1, "9 10"), (2, "None")]


def test_truth_in_cart_order(spark):
    train = spark.createDataFrame([(1, 9, 2, 1), (1, 12, 1, 1), (1, 3, 3, 0), (2, 3, 1, 0)], LINES)
    assert rows(decode.ground_truth(train)) == [(1, "12 9"), (2, "None")]


def test_caps_and_flags(spark):
    df = spark.createDataFrame([(71, "Organic Milk"), (70, "Milk"), (None, None)], "n int, s string")
    got = df.select(cap("n", 70), name_flag("s", "ORGANIC", "y", "n")).collect()
    assert [tuple(r) for r in got] == [(70, "y"), (70, "n"), (None, None)]


def test_streak_needs_the_last_order(spark):
    orders = [(i, 1, "prior", i, 0, 0, 1.0) for i in (1, 2, 3, 4)]
    prior = [(1, 5, 1, 0), (3, 5, 1, 1), (4, 5, 1, 1), (2, 6, 1, 0), (3, 6, 2, 1), (4, 7, 2, 0)]
    got = features.order_streaks(baskets(spark, orders, prior))
    assert rows(got) == [(1, 5, 2), (1, 6, 0), (1, 7, 1)]


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3,), (3,)], "v int")
    got = ranking.histogram(df, "v", 2)
    assert rows(got) == [(0, 2.5, 3.0, 0), (1, 3.0, 3.5, 2)]


def test_first_lines_cross_blocks(spark):
    lines = [(o, p, p, 0) for o in (1, 5, 9, 12) for p in (1, 2, 3)]
    tables = baskets(spark, [], lines)
    for n in (1, 4, 6, 11, 12, 50):
        got = explore.first_n_lines(tables, n, width=4)
        assert rows(got) == sorted(lines)[:n]
    assert explore.table_preview(tables["prior"], "order_id", "product_id", n=2).count() == 2


def test_overlap_of_sets_is_reported(spark):
    tables = baskets(
        spark, [(3, 1, "test", 1, 0, 0, None)], [(1, 5, 1, 0), (2, 5, 1, 0)], [(2, 5, 1, 0), (3, 5, 1, 0)]
    )
    assert rows(matrix_ops.eval_set_disjoint(tables)) == [(3, 1, 0, 1)]

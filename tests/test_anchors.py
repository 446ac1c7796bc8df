"""Counts the derived basket tables must have."""

import pytest
from pyspark.sql import functions as F

from trolley.workspace import workspace

ANCHORS = {
    "sf0.001": dict(
        orders=(1350, 100, 50), users=150, prior=(5263, 921), train=(391, 124), matrix=4342,
        train_rows=(2872, 124), cart=12705.1, ratio=825.4079, streak=(592, 3), truth=(99, 28),
        f1=0.07162308127220408, dims=(106, 25, 5), empty=25,
    ),
    "sf0.01": dict(
        orders=(13500, 1000, 500), users=1500, prior=(53283, 6183), train=(3908, 868),
        matrix=47100, train_rows=(31392, 868), cart=139086.3667, ratio=5885.698,
        streak=(5986, 3), truth=(976, 422), f1=0.14476171337022264, dims=(150, 25, 5), empty=248,
    ),
}


@pytest.fixture(scope="module", params=sorted(ANCHORS))
def case(request, spark):
    return ANCHORS[request.param], workspace(spark, f"/root/testdata/{request.param}")


def test_orders(case):
    want, ws = case
    orders = ws.tables["orders"]
    n = {r[0]: r[1] for r in orders.groupBy("eval_set").count().collect()}
    assert (n["prior"], n["train"], n["test"]) == want["orders"]
    assert orders.select("user_id").distinct().count() == want["users"]
    assert orders.filter("days_since_prior_order is null").count() == want["users"]
    lines = ws.tables["prior"].select("order_id").union(ws.tables["train"].select("order_id"))
    labelled = orders.filter("eval_set <> 'test'")
    without = labelled.join(lines, "order_id", "left_anti").count()
    assert without <= want["empty"]


def test_lines_and_dims(case):
    want, ws = case
    for name in ("prior", "train"):
        got = ws.tables[name].agg(F.count(F.lit(1)), F.sum("reordered")).first()
        assert tuple(got) == want[name]
    dims = ("products", "aisles", "departments")
    assert tuple(ws.tables[d].count() for d in dims) == want["dims"]
    got = ws.tables["order_streaks"].agg(F.sum("order_streak"), F.max("order_streak")).first()
    assert tuple(got) == want["streak"]


def test_matrix(case):
    want, ws = case
    row = ws.matrix.agg(
        F.count(F.lit(1)),
        F.sum("_up_average_cart_position"),
        F.sum("_user_reorder_ratio"),
    ).first()
    assert row[0] == want["matrix"]
    assert row[1] == pytest.approx(want["cart"], abs=1e-3)
    assert row[2] == pytest.approx(want["ratio"], abs=1e-3)
    got = ws.train.agg(F.count(F.lit(1)), F.sum("reordered")).first()
    assert tuple(got) == want["train_rows"]
    assert ws.matrix.select("user_id", "product_id").distinct().count() == want["matrix"]


def test_evaluation(case):
    from trolley.operators import decode, metrics

    want, ws = case
    n = ws.truth.agg(F.count(F.lit(1)), F.count_if(F.col("products") == "None")).first()
    assert tuple(n) == want["truth"]
    lists = decode.complete_lists(ws.scored_train, 0.202)
    assert metrics.mean_f1(ws.truth, lists).first()[0] == pytest.approx(want["f1"], abs=1e-8)


def test_invariants(case):
    _, ws = case
    bad = ws.matrix.filter(
        "_prod_buy_second_time_total_cnt > _prod_buy_first_time_total_cnt"
        " or _prod_buy_first_time_total_cnt > _prod_tot_cnts"
        " or reordered <> 1"
    )
    assert bad.isEmpty()
    from trolley.registry import submission

    lists = submission(ws)
    sample = ws.tables["sample_submission"]
    assert lists.count() == sample.count()
    assert lists.join(sample, "order_id", "left_anti").isEmpty()

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from trolley import schema
from trolley.operators import learn, matrix_ops, metrics, segments, stacking
from trolley.workspace import workspace

QUICK = {"maxIter": 3, "maxDepth": 3}


@pytest.fixture(scope="module")
def ws(spark):
    return workspace(spark, "/root/testdata/sf0.001")


def test_vectors_mark_missing_values(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 1.0, None, 1), (1, 3, 3, 2.0, 5.0, None)],
        "user_id int, product_id int, order_id int, a double, b double, reordered int",
    )
    got = learn.vectorize(matrix_ops.label_fill(df), ["a", "b"], ["b"])
    assert learn.feature_names(got) == ["a", "b", "b_missing"]
    values = {r["product_id"]: (r["label"], list(r["features"].toArray())) for r in got.collect()}
    assert values == {2: (1.0, [1.0, 0.0, 1.0]), 3: (0.0, [2.0, 5.0, 0.0])}


def test_matrix_has_25_model_features(ws):
    assert len(schema.MODEL_FEATURES) == 25
    assert len(learn.feature_names(ws.vectors)) == 25 + len(learn.NULLABLE)


def test_boosting_beats_a_constant_and_repeats(ws):
    model = learn.gbt_train(ws.vectors, {**QUICK, "maxIter": 10})
    auc = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(
        learn.gbt_score(model, ws.vectors)
    )
    assert auc > 0.55
    again = learn.gbt_train(ws.vectors, {**QUICK, "maxIter": 10})
    assert model.toDebugString.splitlines()[1:] == again.toDebugString.splitlines()[1:]
    for by in ("splits", "gain"):
        table = learn.feature_importance(model, ws.vectors, by)
        scores = [r["importance"] for r in table.collect()]
        assert sum(scores) == pytest.approx(1.0)
        assert scores == sorted(scores, reverse=True)


def test_folds_score_every_row_once(ws):
    scored = learn.gbt_cv_scores(ws.train, ws.store, params=QUICK)
    assert scored.count() == ws.train.count()
    assert scored.filter(F.col("fold") != F.col("user_id") % 4).isEmpty()
    lists = learn.folded_lists(scored)
    assert lists.count() == ws.train.select("order_id").distinct().count()


def test_cross_validated_trees_split(ws):
    """Every fold's model tells reorders apart, where a column tells of them (the
    derived tables' purchases are drawn at random), and its lists score otherwise
    than the lists of a model that predicts nothing."""
    noise = F.pmod(F.hash("user_id", "product_id"), F.lit(100)) / 100
    hint = 0.6 * F.coalesce("reordered", F.lit(0)) + noise
    train = ws.train.withColumn("_up_order_rate", hint)
    scored = learn.gbt_cv_scores(train, ws.store, params={"maxIter": 10}).cache()
    for fold in range(4):
        held = scored.filter(F.col("fold") == fold)
        assert held.select("score").distinct().count() > 10
        assert BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(held) > 0.55
    some = learn.folded_lists(scored, 0.1)
    none = learn.folded_lists(scored, 1.0)
    assert none.filter("products <> 'None'").isEmpty()
    assert metrics.mean_f1(ws.truth, some).first() != metrics.mean_f1(ws.truth, none).first()


def test_the_fit_does_not_depend_on_the_layout(ws):
    trees = [
        learn.gbt_train(layout, {**QUICK, "maxIter": 5}).toDebugString.splitlines()[1:]
        for layout in (ws.vectors.coalesce(1), ws.vectors.repartition(5))
    ]
    assert trees[0] == trees[1]


def test_slowly_improving_rounds_are_kept(ws):
    """The best round counts even where each improves by less than 1 %."""
    assert learn.best_round([1.0, 0.995, 0.99, 0.985, 0.99, 0.985]) == 4
    seen, held = matrix_ops.split_rows(ws.train, ["user_id"])
    params = {"maxIter": 12, "maxDepth": 3, "stepSize": 0.01}
    model, scored = learn.gbt_categorical(seen, held, params=params)
    assert model.getNumTrees > 6
    assert scored.count() == held.count()


def test_round_sweep(ws):
    swept = learn.gbt_round_sweep(
        ws.train, ws.truth, ws.store, rounds=[1, 2], k=2, params={"maxDepth": 2}
    )
    assert {r["rounds"] for r in swept.collect()} == {1, 2}


def test_round_search_stops_at_the_best(ws):
    best, table = learn.gbt_rounds(ws.vectors, k=2, max_rounds=4, params=QUICK)
    assert table.count() == best <= 4


def test_categories_get_bins(ws):
    seen, held = matrix_ops.split_rows(ws.train, ["user_id"])
    assert seen.join(held, "user_id", "left_semi").isEmpty()
    model, scored = learn.gbt_categorical(seen, held, params={**QUICK, "maxDepth": 4})
    assert scored.count() == held.count()
    assert model.getMaxBins() >= 32


def test_ridge_grid_lists_every_penalty(ws):
    _, table = learn.ridge_grid(ws.vectors, alphas=[0.1, 10.0], k=2)
    assert [r["alpha"] for r in table.collect()] == [0.1, 10.0]


class MemorizingRegression(LinearRegression):
    """Remembers which folds it was fitted on."""

    seen: list = []

    def _fit(self, dataset):
        MemorizingRegression.seen.append(
            {r["fold"] for r in dataset.select("fold").distinct().collect()}
        )
        return super()._fit(dataset)


def test_no_row_is_scored_by_a_model_that_saw_it(ws):
    MemorizingRegression.seen = []
    model = MemorizingRegression(featuresCol="features", labelCol="label")
    folded = matrix_ops.hash_folds(ws.vectors, schema.PAIR_KEYS, 3, 0)
    oof, test = stacking.oof_layer(folded, ws.test_vectors, {"m": model}, 3)
    assert sorted(map(sorted, MemorizingRegression.seen)) == [[0, 1], [0, 2], [1, 2]]
    assert oof.count() == ws.train.count()
    assert test.count() == ws.test.count()


def test_out_of_fold_prediction_ignores_own_label(spark, ws):
    """Flipping one fold's labels leaves that fold's predictions unchanged."""
    folded = matrix_ops.hash_folds(ws.vectors, schema.PAIR_KEYS, 3, 0)
    flipped = folded.withColumn(
        "label", F.when(F.col("fold") == 1, 1 - F.col("label")).otherwise(F.col("label"))
    )
    model = {"m": LinearRegression(featuresCol="features", labelCol="label", regParam=0.1)}

    def of_fold(frame):
        oof, _ = stacking.oof_layer(frame, ws.test_vectors, model, 3)
        kept = oof.filter("fold = 1").select(*schema.PAIR_KEYS, "m")
        return {tuple(r)[:2]: r["m"] for r in kept.collect()}

    before, after = of_fold(folded), of_fold(flipped)
    assert before.keys() == after.keys()
    assert all(before[k] == pytest.approx(after[k], abs=1e-9) for k in before)


@pytest.mark.parametrize("with_original", [True, False])
def test_stack_shapes(ws, with_original):
    learners = learn.base_learners(ws.ridge_unit, trees=2)
    one = {"lasso": learners["lasso"]}
    done = stacking.oof_stack(
        ws.vectors, ws.test_vectors, one, learners["ridge"], ws.store, k=2,
        with_original=with_original,
    )
    assert done.test.count() == ws.test.count()
    assert done.test.columns == ["user_id", "product_id", "order_id", "score"]
    assert "lasso" in done.oof.columns
    assert [r["model"] for r in done.scores.collect()] == ["lasso"]


def test_pca_scores_are_centred_and_ordered(ws):
    scores, model = segments.user_pca(ws.aisle_counts)
    assert list(model.explainedVariance) == sorted(model.explainedVariance, reverse=True)
    means = scores.agg(*[F.avg(F.col("pc")[i]) for i in range(6)]).first()
    assert max(abs(m) for m in means) < 1e-9
    again, _ = segments.user_pca(ws.aisle_counts.repartition(3))
    a = {r["user_id"]: r["pc"] for r in scores.collect()}
    b = {r["user_id"]: r["pc"] for r in again.collect()}
    assert all(a[u] == pytest.approx(b[u], abs=1e-6) for u in a)


def test_clusters_repeat_under_a_seed(ws):
    points = segments.pca_pair(ws.components)
    first, model = segments.user_clusters(points)
    second, _ = segments.user_clusters(points)
    assert len(model.clusterCenters()) == 4
    assert sorted(first.collect()) == sorted(second.collect())


def test_metric_formulas(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 1.0)], "y int, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["rmse"] == pytest.approx((0.5 / 3) ** 0.5)
    assert row["r2"] == pytest.approx(1 - 0.5 / (2 / 3))
    binary = metrics.binary_metrics(df, "y", "p", 0.7).first()
    assert binary["f1"] == pytest.approx(2 / 3)

"""Searches that read the rows once give what fits of every setting give."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from trolley import schema
from trolley.operators import learn, linear, matrix_ops, staged, stacking
from trolley.sources import Ledger
from trolley.workspace import workspace

QUICK = {"maxDepth": 3}


@pytest.fixture(scope="module")
def ws(spark):
    return workspace(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def booster(ws):
    return learn.gbt_train(ws.vectors, {**QUICK, "maxIter": 9})


def scores(frame, column="score"):
    return {(r["user_id"], r["product_id"]): r[column] for r in frame.collect()}


def test_scores_after_each_round_are_those_of_shorter_fits(ws, booster):
    got = scores(staged.staged_scores(booster, ws.vectors, [2, 9, 5]), "scores")
    for place, rounds in ((0, 2), (1, 9), (2, 5)):
        want = scores(learn.gbt_score(learn.gbt_train(ws.vectors, {**QUICK, "maxIter": rounds}), ws.vectors))
        assert all(got[k][place] == pytest.approx(want[k], abs=1e-12) for k in want)
    with pytest.raises(ValueError):
        staged.staged_scores(booster, ws.vectors, [10])


def test_losses_of_each_round(ws, booster):
    rows = staged.round_losses(booster, ws.vectors.repartition(5)).orderBy("round").collect()
    assert [r["round"] for r in rows] == list(range(1, 10))
    assert [r["loss"] / r["n"] for r in rows] == pytest.approx(booster.evaluateEachIteration(ws.vectors))


def test_leading_trees_are_the_shorter_model(ws, booster):
    cut = staged.leading_trees(booster, 4, learn._boosted({**QUICK, "maxIter": 9}))
    short = learn.gbt_train(ws.vectors, {**QUICK, "maxIter": 4})
    assert cut.getNumTrees == 4 and cut.getMaxDepth() == 3
    assert cut.toDebugString.splitlines()[1:] == short.toDebugString.splitlines()[1:]
    assert scores(learn.gbt_score(cut, ws.vectors)) == scores(learn.gbt_score(short, ws.vectors))


def test_categories_descend_as_in_the_model(ws):
    train, held = matrix_ops.split_rows(ws.train, ["user_id"])
    model, scored = learn.gbt_categorical(train, held, params={"maxIter": 4, "maxDepth": 5}, validate=False)
    trees = staged.read_trees(model)
    assert (trees.codes >= 0).any()
    both = matrix_ops.label_fill(train).unionByName(matrix_ops.label_fill(held))
    sizes = both.agg((F.max("aisle_id") + 1).alias("aisle_id")).first().asDict()
    vectors = learn.vectorize(matrix_ops.label_fill(held), categories=sizes)
    got, want = scores(staged.staged_scores(model, vectors, [4]), "scores"), scores(scored)
    assert got.keys() == want.keys()
    assert all(got[k][0] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_sweep_equals_a_fit_for_every_number_of_rounds(ws):
    swept = learn.gbt_round_sweep(ws.train, ws.truth, ws.store, rounds=[2, 6], k=2, params=QUICK).collect()
    for rounds in (2, 6):
        alone = learn.gbt_cv_f1(ws.train, ws.truth, ws.store, k=2, params={**QUICK, "maxIter": rounds})
        want = {r["fold"]: r["f1"] for r in alone.collect()}
        assert {r["fold"]: r["f1"] for r in swept if r["rounds"] == rounds} == pytest.approx(want)


def test_round_search_is_that_of_the_fits_own_losses(ws):
    best, table = learn.gbt_rounds(ws.vectors, k=2, max_rounds=6, params=QUICK)
    folded = matrix_ops.hash_folds(ws.vectors, schema.PAIR_KEYS, 2, seed=0)
    curves = [
        learn.gbt_train(folded.filter(F.col("fold") != f), {**QUICK, "maxIter": 6}).evaluateEachIteration(
            folded.filter(F.col("fold") == f)
        )
        for f in range(2)
    ]
    means = np.mean(curves, axis=0)
    assert best == int(means.argmin()) + 1
    assert [r["mean_loss"] for r in table.orderBy("round").collect()] == pytest.approx(means[:best].tolist())


def regression(spark, n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1.0, 5.0, 0.2, 3.0] + [0.0, 1000.0, -3.0, 0.0]
    x[:, 3] = x[:, 0] * 0.9 + rng.normal(size=n) * 0.1
    y = x @ [1.0, -0.3, 2.0, 0.5] + 0.5 + rng.normal(size=n)
    data = [(i, i % 3, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(data, ["user_id", "fold", "features", "label"])


@pytest.mark.parametrize("kind, mix, penalties", [("ridge", 0.0, [0.001, 5.0, 300.0]), ("lasso", 1.0, [0.0005, 0.1, 1.0])])
def test_solved_models_are_those_of_spark(spark, kind, mix, penalties):
    x, y, df = regression(spark)
    moments = linear.fold_moments(df.repartition(5))
    models = linear.held_out_models(moments, kind, penalties)
    for fold, part in moments.items():
        seen = df.filter(F.col("fold") != fold)
        unit = learn.ridge_unit(seen) if kind == "ridge" else 1.0
        held = np.arange(len(x)) % 3 == fold
        for penalty, (weights, intercept) in zip(penalties, models[fold]):
            fit = LinearRegression(
                elasticNetParam=mix, regParam=penalty * unit, standardization=False, tol=1e-12, maxIter=5000
            ).fit(seen)
            assert weights == pytest.approx(fit.coefficients.toArray(), abs=1e-6)
            assert intercept == pytest.approx(fit.intercept, abs=1e-3)
            error = ((y[held] - x[held] @ weights - intercept) ** 2).sum()
            assert part.squared_error(weights, intercept) == pytest.approx(error, rel=1e-9)
            assert part.spread() == pytest.approx(((y[held] - y[held].mean()) ** 2).sum(), rel=1e-9)


def test_grid_of_r2_is_that_of_fits(ws):
    alphas = [0.01, 50.0]
    _, table = learn.ridge_grid(ws.vectors, alphas=alphas, k=3)
    folded = matrix_ops.hash_folds(ws.vectors, schema.PAIR_KEYS, 3, seed=0).cache()
    for row in table.collect():
        scored = []
        for fold in range(3):
            seen, held = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
            model = LinearRegression(
                standardization=False, regParam=row["alpha"] * learn.ridge_unit(seen), tol=1e-12, maxIter=5000
            ).fit(seen)
            scored.append(model.evaluate(held).r2)
        assert row["r2"] == pytest.approx(np.mean(scored), abs=1e-5)


def test_grid_by_order_f1_may_choose_otherwise(spark):
    """Two orders of five products each. A large penalty keeps the better
    order of scores within the threshold, a small one has the smaller error."""
    rng = np.random.default_rng(3)
    rows, truth = [], []
    for order in range(200):
        label = rng.random(6) < 0.4
        for product, y in enumerate(label):
            x = float(y) * 0.5 + rng.normal() * 0.3
            rows.append((order, product, order, Vectors.dense([x]), float(y)))
        listed = " ".join(str(p) for p, y in enumerate(label) if y)
        truth.append((order, listed or "None"))
    vectors = spark.createDataFrame(rows, ["user_id", "product_id", "order_id", "features", "label"])
    truth = spark.createDataFrame(truth, "order_id long, products string")
    alphas = [0.01, 1e3]
    by_r2, table = learn.ridge_grid(vectors, alphas, k=2)
    by_f1, judged = learn.ridge_grid(vectors, alphas, k=2, truth=truth, threshold=0.41)
    found = {r["alpha"]: (r["r2"], r["f1"]) for r in judged.collect()}
    assert {a: v[0] for a, v in found.items()} == pytest.approx({r["alpha"]: r["r2"] for r in table.collect()})
    best_r2, best_f1 = (max(found, key=lambda a, i=i: found[a][i]) for i in (0, 1))
    assert best_r2 == 0.01
    unit = learn.ridge_unit(vectors)
    assert by_r2.getRegParam() == pytest.approx(best_r2 * unit)
    assert by_f1.getRegParam() == pytest.approx(best_f1 * unit)


def test_lasso_search_takes_the_least_error(ws):
    search = learn.LassoSearch([1.0, 0.001])
    errors = search.errors(ws.vectors)
    model = search.fit(ws.vectors)
    assert model.getRegParam() == [1.0, 0.001][int(np.argmin(errors))]


class Counted(LinearRegression):
    fits = 0

    def _fit(self, dataset):
        Counted.fits += 1
        if Counted.fits == 5:
            raise RuntimeError("broken off")
        return super()._fit(dataset)


def test_a_broken_off_stack_goes_on_where_it_ended(ws, tmp_path, monkeypatch):
    monkeypatch.setattr(learn, "CONCURRENT_FITS", 1)
    monkeypatch.setattr(learn.concurrently, "__defaults__", (1,))
    ledger = Ledger(ws.spark, str(tmp_path / "ledger"))
    # an instance of its own for each run, as a new session would have
    models = lambda: {"a": Counted(regParam=0.1), "b": Counted(regParam=0.2)}
    meta = LinearRegression(regParam=0.1)
    run = lambda: stacking.oof_stack(ws.vectors, ws.test_vectors, models(), meta, ws.store, k=4, ledger=ledger)
    Counted.fits = 0
    with pytest.raises(RuntimeError, match="broken off"):
        run()
    done = run()
    assert Counted.fits == 5 + 4  # four fits were kept, four are left
    again = run()
    assert Counted.fits == 9
    plain = stacking.oof_stack(
        ws.vectors, ws.test_vectors, {n: LinearRegression(regParam=m.getRegParam()) for n, m in models().items()}, meta, ws.store, k=4
    )
    want = scores(plain.test)
    for got in (done, again):
        assert scores(got.test) == pytest.approx(want)


def test_the_ledger_tells_rows_and_settings_apart(ws, tmp_path):
    ledger = Ledger(ws.spark, str(tmp_path / "ledger"))
    rows = ws.spark.createDataFrame([(1, 2.0), (2, 3.0)], "a int, b double")
    assert ledger.fingerprint(rows) == ledger.fingerprint(rows.repartition(3).select("b", "a"))
    assert ledger.fingerprint(rows) != ledger.fingerprint(rows.withColumn("b", F.col("b") + 1))
    assert ledger.fingerprint(rows) != ledger.fingerprint(rows.unionByName(rows))
    built = []
    build = lambda: built.append(1) or rows
    assert ledger.table("x", build).count() == ledger.table("x", build).count() == 2
    assert ledger.table("y", build).count() == 2
    assert len(built) == 2


def test_partitions_of_a_fit_follow_rows_and_trees():
    assert learn.fit_partitions(0) == learn.fit_partitions(1) == 1
    assert learn.fit_partitions(learn.ROWS_PER_FIT_PARTITION + 1) == 2
    assert learn.fit_partitions(30_000, 1000) == 8


def test_partitions_of_a_large_fit_are_full():
    """A pass over 65,536 rows costs as much to start as to make."""
    small = learn.ROWS_PER_FIT_PARTITION
    assert [learn.fit_partitions(n * small) for n in (1, 2, 3, 4, 5, 12, 13)] == [1, 2, 3, 3, 3, 3, 4]
    assert learn.fit_partitions(3_160_670) == 13
    assert learn.fit_partitions(100 * learn.ROWS_PER_FULL_FIT_PARTITION) == 100


def test_linear_fits_move_no_rows(ws, monkeypatch):
    """The sums of a linear fit are the same in any layout; no copy of the rows is dealt out or kept."""
    vectors = ws.vectors

    def forbidden(*args, **kwargs):
        raise AssertionError("a linear fit wrote or moved its rows")

    plain = LinearRegression(featuresCol="features", labelCol="label", regParam=0.1)
    few = [learn.fitted(plain, vectors.repartition(n)).coefficients for n in (2, 5)]
    assert few[0] == few[1]  # one partition's rows are added in one order
    monkeypatch.setattr(learn, "ROWS_PER_FIT_PARTITION", 16)
    monkeypatch.setattr(learn, "spread", forbidden)
    monkeypatch.setattr(learn.Store, "put", forbidden)
    for learner in (plain, learn.LassoSearch()):
        assert learn.fitted(learner, vectors).numFeatures > 0
    assert learn.ridge_grid(vectors, [0.5, 1.0], k=2)[1].count() == 2


@pytest.mark.parametrize("keep", [[], ["fold"]])
def test_lists_of_several_scores_are_those_of_each(spark, keep):
    from trolley.operators import decode

    rows = [
        (1, 3, 0, [0.9, 0.1]), (1, 12, 0, [0.8, 0.7]), (1, 3, 0, [0.6, 0.2]), (2, 5, 1, [0.1, 0.2]),
        (None, 7, 1, [0.9, 0.1]), (3, None, 0, [0.9, 0.9]), (4, 1, 0, [None, float("nan")]),
    ]
    scored = spark.createDataFrame(rows, "order_id int, product_id int, fold int, scores array<double>")
    got = decode.staged_lists(scored, 0.5, 2, keep=keep)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan[plan.index("Aggregate") :]  # a row is grouped once
    each = scored.select("order_id", "product_id", *keep, F.posexplode("scores").alias("at", "score"))
    want = decode.complete_lists(each, 0.5, keep=["at", *keep]).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

"""Results without SQL, against plain numpy on the whole small dataset."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from trolley import schema
from trolley.operators import decode, learn, matrix_ops, metrics, segments
from trolley.workspace import workspace


@pytest.fixture(scope="module")
def ws(spark):
    return workspace(spark, "/root/testdata/sf0.001")


def test_pca_against_svd(ws):
    table = ws.aisle_counts.toPandas().pivot(index="user_id", columns="aisle", values="n").fillna(0).sort_index()
    centred = table.to_numpy(float) - table.to_numpy(float).mean(axis=0)
    _, _, rows = np.linalg.svd(centred, full_matrices=False)
    scores, _ = segments.user_pca(ws.aisle_counts)
    got = np.array([r["pc"] for r in scores.orderBy("user_id").collect()])
    for i in range(6):
        want = centred @ rows[i]
        sign = 1.0 if rows[i][np.argmax(np.abs(rows[i]))] >= 0 else -1.0
        assert got[:, i] == pytest.approx(sign * want, abs=1e-6)


def test_leading_vectors_of_close_values():
    rng = np.random.default_rng(0)
    basis = np.linalg.qr(rng.normal(size=(60, 60)))[0]
    values = np.r_[5.0, 4.99, 3.0, np.linspace(2.9, 0.0, 57)]
    got, vectors = segments.leading_vectors(basis @ np.diag(values) @ basis.T, 3)
    assert got == pytest.approx(values[:3], abs=1e-9)
    assert np.abs(np.sum(vectors * basis[:, :3], axis=0)) == pytest.approx(np.ones(3), abs=1e-7)


def test_clusters_are_nearest_centres(ws):
    points, model = segments.user_clusters(segments.pca_pair(ws.components))
    rows = points.collect()
    centres = np.array(model.clusterCenters())
    xy = np.array([(r["x"], r["y"]) for r in rows])
    nearest = ((xy[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert [r["segment"] for r in rows] == nearest.tolist()


def _regression(spark, n=400):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2]
    y = x @ [1.0, -0.3, 2.0] + 0.5 + rng.normal(size=n)
    data = [(Vectors.dense(a), float(b)) for a, b in zip(x, y)]
    return x, y, spark.createDataFrame(data, ["features", "label"])


@pytest.mark.parametrize("alpha", [0.5, 50.0])
def test_ridge_penalty_applies_to_the_summed_error(spark, alpha):
    x, y, df = _regression(spark)
    model = LinearRegression(
        elasticNetParam=0.0, regParam=alpha * learn.ridge_unit(df), standardization=False, tol=1e-12
    ).fit(df)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(want, rel=1e-5)


def test_lasso_penalty_applies_to_the_mean_error(spark):
    x, y, df = _regression(spark)
    lam = 0.2
    model = LinearRegression(
        elasticNetParam=1.0, regParam=lam, standardization=False, tol=1e-12, maxIter=500
    ).fit(df)
    w = model.coefficients.toArray()
    xc, yc = x - x.mean(axis=0), y - y.mean()
    gradient = xc.T @ (yc - xc @ w) / len(y)
    for g, c in zip(gradient, w):
        if abs(c) > 1e-8:
            assert g == pytest.approx(lam * np.sign(c), abs=1e-4)
        else:
            assert abs(g) <= lam + 1e-4


def test_importance_counts_splits(ws):
    model = learn.gbt_train(ws.vectors, {"maxIter": 3, "maxDepth": 3})
    table = learn.feature_importance(model, ws.vectors)
    internal = sum((tree.numNodes - 1) // 2 for tree in model.trees)
    shares = [r["importance"] * internal for r in table.collect()]
    assert sum(shares) == pytest.approx(internal)
    assert all(s == pytest.approx(round(s)) for s in shares)


def test_scores_are_the_logistic_of_the_trees(ws):
    model = learn.gbt_train(ws.vectors, {"maxIter": 3, "maxDepth": 2})
    rows = ws.vectors.limit(50).collect()
    scored = learn.gbt_score(model, ws.vectors)
    by_key = {(r["user_id"], r["product_id"]): r["score"] for r in scored.collect()}
    for r in rows:
        margin = sum(w * t.predict(r["features"]) for w, t in zip(model.treeWeights, model.trees))
        want = 1 / (1 + np.exp(-2 * margin))
        assert by_key[r["user_id"], r["product_id"]] == pytest.approx(want)


def test_mean_f1_by_hand(ws):
    lists = {r[0]: r[1] for r in decode.complete_lists(ws.scored_train, 0.202).collect()}
    truth = {r[0]: r[1] for r in ws.truth.collect()}
    total = []
    for order, products in lists.items():
        if order not in truth:
            continue
        p = products.replace("None", "-1").split(" ")
        t = truth[order].replace("None", "-1").split(" ")
        hits = len(set(p) & set(t))
        total.append(2 * hits / (len(p) + len(t)) if hits else 0.0)
    frame = decode.complete_lists(ws.scored_train, 0.202)
    assert metrics.mean_f1(ws.truth, frame).first()[0] == pytest.approx(np.mean(total))


def test_split_is_a_partition_of_the_rows(ws):
    seen, held = matrix_ops.split_rows(ws.train, schema.PAIR_KEYS, test_size=0.3)
    n, m = seen.count(), held.count()
    assert n + m == ws.train.count()
    assert m / (n + m) == pytest.approx(0.3, abs=0.03)
    assert seen.join(held, schema.PAIR_KEYS, "left_semi").isEmpty()


def test_hash_folds_are_even(ws):
    sizes = matrix_ops.hash_folds(ws.train, schema.PAIR_KEYS, 5, 0).groupBy("fold").count()
    counts = [r["count"] for r in sizes.collect()]
    assert len(counts) == 5
    assert min(counts) > 0.8 * max(counts)


def test_out_of_fold_columns_have_no_gaps(spark, ws):
    from trolley.registry import QUERIES

    oof = QUERIES["oof_stack_train"](spark, "/root/testdata/sf0.001")
    assert oof.filter(F.col("ridge").isNull() | F.col("lasso").isNull()).isEmpty()
    assert oof.select(*schema.PAIR_KEYS).distinct().count() == ws.train.count()

"""Boosted trees and linear learners on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from math import sqrt
from statistics import fmean, pstdev
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..sources.store import Ledger, Store, scratch_root
from . import trees
from .decode import complete_lists, decode, staged_lists, submission
from .linear import fold_moments, held_out_models, scores_by_penalty
from .matrix_ops import hash_folds, label_fill, user_folds
from .metrics import fold_scores, order_f1
from .staged import FEATURES, LABEL, leading_trees, round_losses, staged_scores

T = TypeVar("T")
IDS = ["user_id", "product_id", "order_id"]

# Settings of the boosted-tree runs. L1 and L2 leaf penalties have
# no counterpart in Spark ML.
SUBMIT = {
    "stepSize": 0.0917,
    "maxDepth": 6,
    "minInstancesPerNode": 10,
    "minInfoGain": 0.0,
    "subsamplingRate": 0.76,
    "featureSubsetStrategy": "0.95",
    "maxIter": 300,
    "seed": 100,
}
# The published run's gamma of 0.7 is a loss reduction summed over a node's rows;
# Spark ML's minInfoGain is a variance reduction per row, below 0.15 for any 0/1
# label, so that 0.7 would forbid every split. Summed over rows, 0.7 is next to 0.
CROSS_VALIDATE = {**SUBMIT, "stepSize": 0.1, "minInfoGain": 0.0, "maxIter": 80, "seed": 10}
CATEGORICAL = {"stepSize": 0.05, "maxDepth": 8, "maxIter": 100, "seed": 42}
SEARCH = {"k": 5, "max_rounds": 200, "patience": 20}
ROUND_SWEEP = [250, 350, 400, 450, 500]
THRESHOLD = 0.202
ROWS_PER_FIT_PARTITION = 1 << 16  # of 32 features: 16 MB of vectors, a quarter binned
FEW_FIT_PARTITIONS = 3  # beyond these, a partition holds more rows
ROWS_PER_FULL_FIT_PARTITION = 1 << 18  # 64 MB: a level's pass over fewer costs as much to start as to make
TREE_ROWS_PER_PARTITION = 1 << 22  # of a forest, whose trees all grow in one pass
CONCURRENT_FITS = 5  # each holds its rows in the executors' memory
# The penalties that are tried.
RIDGE_ALPHAS = [
    1e-3, 5e-3, 1e-2, 5e-2, 1e-1, 0.2, 0.3, 0.4, 0.5, 0.8, 1.0, 3.0, 5.0, 7.0, 10.0,
]
LASSO_ALPHAS = [1.0, 0.1, 0.001, 0.0005]

# Matrix columns that can be missing.
NULLABLE = [
    "_user_sum_days_since_prior_order",
    "_user_mean_days_since_prior_order",
    "_user_reorder_ratio",
    "time_since_last_order",
    "aisle_id",
    "department_id",
    "order_streak",
]


def vectorize(
    df: DataFrame,
    features: Sequence[str] = tuple(schema.MODEL_FEATURES),
    nullable: Sequence[str] = tuple(NULLABLE),
    categories: Mapping[str, int] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Ids, label and one feature vector per row.

    A missing value becomes 0 beside a 0/1 indicator, which a tree can split
    on. ``categories`` names code columns and their number of codes; those are
    marked nominal, and a missing code becomes a category of its own.
    """
    sizes = dict(categories or {})
    slots: list[Column] = []
    for f in features:
        slot = f"_f_{f}"  # apart from ids and kept columns of the same name
        value = F.col(f).cast("double")
        if f in sizes:
            codes = {"type": "nominal", "name": slot, "num_vals": sizes[f] + 1}
            filled = F.coalesce(value, F.lit(float(sizes[f])))
            slots.append(filled.alias(slot, metadata={"ml_attr": codes}))
            continue
        slots.append(F.coalesce(value, F.lit(0.0)).alias(slot))
        if f in nullable:
            slots.append(F.col(f).isNull().cast("double").alias(f"{slot}_missing"))
    held = [F.col(c) for c in IDS + list(keep) if c in df.columns]
    if schema.LABEL in df.columns:
        held.append(F.col(schema.LABEL).cast("double").alias(LABEL))
    wide = df.select(*held, *slots)
    inputs = [c for c in wide.columns if c.startswith("_f_")]
    assembled = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(wide)
    return assembled.drop(*inputs)


def feature_names(vectors: DataFrame) -> list[str]:
    """Names of the vector's slots, in order."""
    attrs = vectors.schema[FEATURES].metadata["ml_attr"]["attrs"]
    slots = sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])
    return [a["name"].removeprefix("_f_") for a in slots]


def _boosted(params: Mapping[str, object], **extra: object) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, **{**SUBMIT, **params, **extra}
    )


def _checkpointed(df: DataFrame) -> None:
    """Boosting checkpoints every 10 rounds when a shared folder is known."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))


def fit_partitions(rows: int, trees: int = 1) -> int:
    """Partitions for a fit: by rows, and for forests by rows times trees."""
    few = min(FEW_FIT_PARTITIONS, -(-rows // ROWS_PER_FIT_PARTITION))
    full = -(-rows // ROWS_PER_FULL_FIT_PARTITION)
    return max(1, few, full, -(-rows * trees // TREE_ROWS_PER_PARTITION))


def spread(vectors: DataFrame, estimator: object = None) -> DataFrame:
    """``vectors`` dealt by hash of their keys and sorted in each partition.
    Trees draw their rows per partition, so that a fit would otherwise depend
    on the layout of its input; here it depends on the rows and the settings,
    not on the cluster. A boosting round is a pass over the rows for each level
    of its tree: few rows are best held by few tasks."""
    keys = [c for c in IDS if c in vectors.columns]
    if not keys:
        return vectors
    grown = estimator.getNumTrees() if isinstance(estimator, RandomForestRegressor) else 1
    parts = fit_partitions(vectors.count(), grown)
    return vectors.repartition(parts, *keys).sortWithinPartitions(*keys)


def complete_rows(vectors: DataFrame) -> int:
    """The number of rows; 0 where one lacks its features or has a label that is
    missing or other than 0 and 1, which is for Spark ML to refuse or to take."""
    odd = F.col(FEATURES).isNull() | ~F.coalesce(F.col(LABEL).isin(0, 1), F.lit(False))
    row = vectors.agg(F.count("*").alias("n"), F.count_if(odd).alias("odd")).first()
    return 0 if row["odd"] else row["n"]


def concurrently(jobs: Sequence[Callable[[], T]], at_once: int = CONCURRENT_FITS) -> list[T]:
    """The results of independent jobs, some run at the same time."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def settings_of(estimator: Estimator) -> dict[str, object]:
    """Its parameters by name, for the key of a ledger's entry."""
    own = {k: v for k, v in vars(estimator).items() if k[0] != "_" and k != "uid" and not isinstance(v, Param)}
    named = {p.name: v for p, v in estimator.extractParamMap().items()}
    return {"kind": type(estimator).__name__} | {k: repr(v) for k, v in (own | named).items()}


def fitted(estimator: Estimator, vectors: DataFrame, ledger: Ledger | None = None, data: object = None) -> Model:
    """The estimator's model of ``vectors``, from the ledger where it is known.
    ``data`` tells these rows from others; by default their fingerprint."""

    def fit() -> Model:
        # sums of products over several partitions need no layout: rows are read in
        # place. Those of one partition are dealt, and so added in a fixed order.
        linear = isinstance(estimator, LinearRegression | LassoSearch)
        if linear and fit_partitions(vectors.count()) > 1:
            return estimator.fit(vectors)
        rows = complete_rows(vectors) if trees.offered(estimator) else 0
        if ROWS_PER_FIT_PARTITION < rows <= trees.ROWS_PER_TASK:
            return trees.fit(estimator, vectors, rows)
        return estimator.fit(spread(vectors, estimator))

    if ledger is None or not hasattr(estimator, "extractParamMap"):
        return fit()
    return ledger.model(ledger.key("fit", settings_of(estimator), data or ledger.fingerprint(vectors)), fit)


def gbt_train(
    vectors: DataFrame,
    params: Mapping[str, object] | None = None,
    ledger: Ledger | None = None,
    data: object = None,
) -> GBTClassificationModel:
    """Boosted trees with logistic loss on labelled :func:`vectorize` output."""
    _checkpointed(vectors)
    return fitted(_boosted(params or {}), vectors, ledger, data)


def probability_of(frame: DataFrame) -> Column:
    """A classifier's probability of 1, a regressor's prediction."""
    if "probability" in frame.columns:
        return vector_to_array("probability")[1]
    return F.col("prediction")


def score_with(model: Model, vectors: DataFrame, name: str = "score") -> DataFrame:
    scored = model.transform(vectors)
    added = [c for c in scored.columns if c not in vectors.columns]
    return scored.withColumn(name, probability_of(scored)).drop(*added)


def gbt_score(model: GBTClassificationModel, vectors: DataFrame) -> DataFrame:
    """Ids and ``score``, the probability of a reorder."""
    return score_with(model, vectors).drop(FEATURES)


def _stored_folds(train: DataFrame, store: Store, k: int) -> DataFrame:
    """Vectors of the labelled rows, stored as one folder per fold."""
    folded = vectorize(user_folds(label_fill(train), k), keep=["fold"])
    return store.put_partitioned(folded, "cv_folds", ["fold"])


def fold_boosters(
    folded: DataFrame, k: int, params: Mapping[str, object], ledger: Ledger | None = None
) -> list[GBTClassificationModel]:
    """For each fold, boosted trees of the other folds' rows."""
    data = ledger.fingerprint(folded) if ledger else None
    return concurrently(
        [
            lambda fold=fold: gbt_train(folded.filter(F.col("fold") != fold), params, ledger, [data, fold, k])
            for fold in range(k)
        ]
    )


def gbt_cv_scores(
    train: DataFrame,
    store,
    k: int = 4,
    params: Mapping[str, object] | None = None,
    categorical: Sequence[str] = (),
    ledger: Ledger | None = None,
) -> DataFrame:
    """(fold, ids, label, score): each row scored by the model of the folds it
    is not in. Folds are user_id mod k, stored as folders so that each fit
    reads only its own, and fitted at the same time. With ``categorical``
    columns the fits are those of :func:`gbt_categorical`, the held-out fold
    stopping the boosting."""
    if categorical:
        stored = store.put_partitioned(user_folds(label_fill(train), k), "cv_folds", ["fold"])

        def part(fold: int) -> DataFrame:
            seen, held = (stored.filter(c) for c in (F.col("fold") != fold, F.col("fold") == fold))
            scored = gbt_categorical(seen, held, categorical, params, ledger=ledger)[1]
            return scored.withColumn("fold", F.lit(fold))

        parts = concurrently([lambda fold=fold: part(fold) for fold in range(k)])
    else:
        stored = _stored_folds(train, store, k)
        models = fold_boosters(stored, k, {**CROSS_VALIDATE, **(params or {})}, ledger)
        parts = [gbt_score(model, stored.filter(F.col("fold") == fold)) for fold, model in enumerate(models)]
    return reduce(DataFrame.unionByName, parts)


def folded_lists(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(fold, order_id, products) over all folds in one grouping."""
    lists = complete_lists(scored, threshold, keep=["fold"])
    return lists.select("fold", "order_id", "products")


def gbt_cv_f1(
    train: DataFrame,
    truth: DataFrame,
    store,
    k: int = 4,
    params: Mapping[str, object] | None = None,
    threshold: float = THRESHOLD,
    categorical: Sequence[str] = (),
    ledger: Ledger | None = None,
) -> DataFrame:
    """F1 per fold, mean of folds and pooled F1."""
    scored = gbt_cv_scores(train, store, k, params, categorical, ledger)
    return fold_scores(truth, folded_lists(scored, threshold))


def gbt_round_sweep(
    train: DataFrame,
    truth: DataFrame,
    store,
    rounds: Sequence[int] | None = None,
    k: int = 4,
    params: Mapping[str, object] | None = None,
    threshold: float = THRESHOLD,
    ledger: Ledger | None = None,
) -> DataFrame:
    """(rounds, fold, f1): :func:`gbt_cv_f1` for several numbers of rounds, by
    default those of ``ROUND_SWEEP``. One fit per fold, of the largest number; one
    pass over the held-out rows scores them after each of ``rounds``."""
    rounds = list(ROUND_SWEEP if rounds is None else rounds)
    stored = _stored_folds(train, store, k)
    models = fold_boosters(stored, k, {**CROSS_VALIDATE, **(params or {}), "maxIter": max(rounds)}, ledger)
    parts = [
        staged_scores(model, stored.filter(F.col("fold") == fold), rounds).select(*IDS, F.lit(fold).alias("fold"), "scores")
        for fold, model in enumerate(models)
    ]
    every = reduce(DataFrame.unionByName, parts)
    number = F.array(*map(F.lit, rounds))[F.col("at")].cast("int").alias("rounds")
    lists = staged_lists(every, threshold, len(rounds), keep=["fold"]).select("*", number).drop("at")
    return fold_scores(truth, store.put(lists, "sweep_lists"), by=["rounds"])


def gbt_rounds(
    vectors: DataFrame,
    k: int = SEARCH["k"],
    max_rounds: int = SEARCH["max_rounds"],
    patience: int = SEARCH["patience"],
    params: Mapping[str, object] | None = None,
    ledger: Ledger | None = None,
) -> tuple[int, DataFrame]:
    """Number of rounds by cross-validated loss, stopping once the mean over
    the folds has not improved for ``patience`` rounds; and the loss table
    (round, mean_loss, std_loss) up to there. One fit per fold; its losses
    after all rounds come from one pass over the held-out rows."""
    folded = hash_folds(vectors, schema.PAIR_KEYS, k, seed=0)
    folded = Store(vectors.sparkSession).put_partitioned(folded, "round_folds", ["fold"])
    models = fold_boosters(folded, k, {**(params or {}), "maxIter": max_rounds}, ledger)
    curves = []
    for fold, model in enumerate(models):
        losses = round_losses(model, folded.filter(F.col("fold") == fold)).orderBy("round")
        curves.append([r["loss"] / r["n"] for r in losses.collect()])  # one row a round
    rows = [(r, fmean(c), pstdev(c)) for r, c in enumerate(zip(*curves), start=1)]
    best = 0
    for i, (_, mean, _) in enumerate(rows):
        if mean < rows[best][1]:
            best = i
        elif i - best >= patience:
            break
    kept = rows[: best + 1]
    table = vectors.sparkSession.createDataFrame(
        kept, "round int, mean_loss double, std_loss double"
    )
    return kept[-1][0], table


def gbt_categorical(
    train: DataFrame,
    scored: DataFrame,
    columns: Sequence[str] = ("aisle_id",),
    params: Mapping[str, object] | None = None,
    validate: bool = True,
    ledger: Ledger | None = None,
) -> tuple[GBTClassificationModel, DataFrame]:
    """Boosted trees that take code columns as categories. Returns the model
    and the scored rows. With ``validate`` those rows are labelled, and the model
    is cut after the round, of all rounds, with the least loss on them. Without,
    all rounds count."""
    both = (
        label_fill(train).withColumn("held_out", F.lit(0))
        .unionByName(label_fill(scored).withColumn("held_out", F.lit(1)))
    )
    sizes = both.agg(*[(F.max(c) + 1).alias(c) for c in columns]).first()
    vectors = vectorize(both, categories=sizes.asDict(), keep=["held_out"])
    _checkpointed(vectors)
    learner = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        # a split on a category needs a bin per category
        maxBins=max(32, *[s + 1 for s in sizes]),
        **{**CATEGORICAL, **(params or {})},
    )
    vectors = Store(train.sparkSession).put_partitioned(vectors, "categorical", ["held_out"])
    seen, held = vectors.filter("held_out = 0"), vectors.filter("held_out = 1")
    model = fitted(learner, seen, ledger)
    if validate:
        losses = round_losses(model, held).orderBy("round").collect()  # one row a round
        best = best_round([r["loss"] for r in losses]) if losses else model.getNumTrees
        model = leading_trees(model, best, learner)
    return model, gbt_score(model, held).drop("held_out")


def best_round(losses: Sequence[float]) -> int:
    """The first round, from 1, with the least loss."""
    return min(range(len(losses)), key=losses.__getitem__) + 1


def gbt_submission(
    train: DataFrame,
    test: DataFrame,
    sample: DataFrame,
    store,
    params: Mapping[str, object] | None = None,
    threshold: float = THRESHOLD,
    model: GBTClassificationModel | None = None,
) -> DataFrame:
    """One list per sample order, from a model fitted on the train matrix, or
    from the given one."""
    if model is None:
        vectors = store.put(vectorize(label_fill(train)), "fit_vectors")
        model = gbt_train(vectors, params)
    return submission(sample, decode(gbt_score(model, vectorize(test)), threshold))


def feature_importance(
    model: GBTClassificationModel, vectors: DataFrame, by: str = "splits"
) -> DataFrame:
    """(feature, importance) of the features in use: shares that sum to 1,
    largest first, of the number of splits on the feature or of their gain."""
    if by == "gain":
        weights = dict(enumerate(model.featureImportances.toArray().tolist()))
    else:
        path = Store(vectors.sparkSession).path("forest")
        model.write().save(path)
        slot = F.col("nodeData.split.featureIndex")
        nodes = vectors.sparkSession.read.parquet(f"{path}/data").filter(slot >= 0)  # the inner ones
        splits = nodes.groupBy(slot.alias("slot")).count().collect()  # one row a feature
        weights = {r["slot"]: r["count"] for r in splits}
    total = sum(weights.values()) or 1
    names = feature_names(vectors)
    rows = [(names[slot], w / total) for slot, w in weights.items() if w > 0]
    table = vectors.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def ridge_unit(vectors: DataFrame) -> float:
    """``regParam`` of a ridge penalty of 1 on the summed squared error: Spark
    penalises the mean error and divides the parameter by the label's standard
    deviation."""
    spread, n = vectors.agg(F.stddev_pop(LABEL), F.count(LABEL)).first()
    return (spread or 1.0) / max(n, 1)


def base_learners(unit: float, trees: int | None = None) -> dict[str, Estimator]:
    """The base learners of the stack that Spark ML offers. ``unit`` is the
    :func:`ridge_unit` of the train vectors; ``trees`` overrides the size of
    the ensembles. ``elastic`` keeps its published penalty, which selects no
    feature on a label as rare as a reorder: it predicts the mean. ``lasso_cv``
    chooses its penalty by cross-validation. ``boosted_classifier`` is the first
    learner of the first layer, ``forest_second`` one of the second."""
    # The published settings.
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    # the penalties are meant for features as they are
    linear = {**common, "standardization": False}
    classifier = _boosted({"seed": 0, "maxIter": trees or SEARCH["max_rounds"]})
    return {
        "boosted_classifier": classifier,
        "forest_deep": RandomForestRegressor(
            maxDepth=16, numTrees=trees or 250, minInstancesPerNode=20,
            featureSubsetStrategy="0.4", seed=5, **common,
        ),
        "forest_wide": RandomForestRegressor(
            maxDepth=8, numTrees=trees or 1000, featureSubsetStrategy="all", seed=0, **common
        ),
        "boosted": GBTRegressor(
            stepSize=0.05, maxIter=trees or 50, minInstancesPerNode=60,
            subsamplingRate=0.8, featureSubsetStrategy="0.4", maxDepth=5, seed=0, **common,
        ),
        "ridge": LinearRegression(elasticNetParam=0.0, regParam=0.5 * unit, **linear),
        "lasso": LinearRegression(elasticNetParam=1.0, regParam=0.01, **linear),
        "elastic": LinearRegression(
            elasticNetParam=1.0, regParam=0.00452445, maxIter=32, **common
        ),
        "lasso_cv": LassoSearch(),
        "forest_second": RandomForestRegressor(
            maxDepth=12, numTrees=trees or 100, minInstancesPerNode=2,
            featureSubsetStrategy="0.2", seed=0, **common,
        ),
    }


def _with_folds(vectors: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Vectors with a fold from a hash of the keys; where they have none, of the
    features. The hash is cheaper to repeat in each pass than a copy is to write."""
    known = [c for c in keys if c in vectors.columns]
    if known:
        return hash_folds(vectors, known, k, seed=0)
    return vectors.withColumn("fold", F.pmod(F.xxhash64(FEATURES), F.lit(k)).cast("int"))


class LassoSearch(Estimator):
    """Lasso with its penalty chosen by cross-validated error. The errors of all
    penalties come from one pass over the rows (:mod:`.linear`); the chosen one
    is then fitted by Spark ML."""

    def __init__(self, penalties: Sequence[float] = tuple(LASSO_ALPHAS), k: int = 3, keys: Sequence[str] = tuple(schema.PAIR_KEYS)):
        super().__init__()
        self.penalties, self.k, self.keys = list(penalties), k, list(keys)

    def errors(self, vectors: DataFrame) -> list[float]:
        """Root of the mean squared error of each penalty, mean of the folds."""
        moments = fold_moments(_with_folds(vectors, self.keys, self.k))
        models = held_out_models(moments, "lasso", self.penalties)
        by_fold = [
            [sqrt(max(part.squared_error(*m), 0.0) / part.rows) for m in models[fold]] for fold, part in moments.items()
        ]
        return [fmean(e) for e in zip(*by_fold)]

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        errors = self.errors(dataset)
        best = self.penalties[min(range(len(errors)), key=errors.__getitem__)]
        return LinearRegression(
            featuresCol=FEATURES, labelCol=LABEL, elasticNetParam=1.0, regParam=best, standardization=False
        ).fit(dataset)


def ridge_grid(
    vectors: DataFrame,
    alphas: Sequence[float] = tuple(RIDGE_ALPHAS),
    k: int = 5,
    keys: Sequence[str] = tuple(schema.PAIR_KEYS),
    truth: DataFrame | None = None,
    threshold: float = THRESHOLD,
) -> tuple[LinearRegressionModel, DataFrame]:
    """Ridge regression with its penalty, on the summed squared error, chosen by
    k-fold cross-validation; and the table (alpha, r2), means of the folds. Folds
    come from a hash of the keys. One pass adds up each fold's products
    of columns, and every penalty's fits and errors are solved from these.

    With ``truth``, the lists of the train orders, the table has a third column
    f1, the mean over the orders of the F1 of the lists that the held-out scores
    decode to, and the penalty with the largest f1 wins: one more pass scores
    the held-out rows by all penalties."""
    folded = _with_folds(vectors, keys, k)
    moments = fold_moments(folded)
    models = held_out_models(moments, "ridge", alphas)
    r2 = [
        fmean(1 - part.squared_error(*models[fold][i]) / part.spread() for fold, part in moments.items())
        for i in range(len(alphas))
    ]
    columns = {"alpha": [float(a) for a in alphas], "r2": r2}
    if truth is not None:
        columns["f1"] = _f1_by_penalty(folded, models, truth, threshold, len(alphas))
    goal = columns["r2" if truth is None else "f1"]
    best = max(range(len(alphas)), key=goal.__getitem__)
    model = LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, elasticNetParam=0.0, standardization=False,
        regParam=alphas[best] * ridge_unit(vectors),
    ).fit(vectors)
    table = vectors.sparkSession.createDataFrame(
        list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)
    )
    return model, table


def _f1_by_penalty(folded: DataFrame, models, truth: DataFrame, threshold: float, n: int) -> list[float]:
    """Mean F1 of the train orders' lists, for each penalty."""
    scored = scores_by_penalty(folded.select(*IDS, "fold", FEATURES), models)
    lists = staged_lists(scored, threshold, n).withColumnRenamed("at", "penalty")
    means = order_f1(truth, lists, "penalty").groupBy("penalty").agg(F.avg("f1").alias("f1"))
    found = {r["penalty"]: r["f1"] for r in means.collect()}  # one row a penalty
    return [found.get(i, 0.0) for i in range(n)]

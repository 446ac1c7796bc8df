"""Every operator and report as a named query over one dataset.

Each query reads the whole tables. A number rounded here is a floating-point
sum whose last digits depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .functions.columns import flag_above
from .functions.stats import GroupFunction
from .operators import (
    decode,
    encode,
    groups,
    joins,
    learn,
    linear,
    matrix_ops,
    metrics,
    ranking,
    segments,
    stacking,
)
from .plans import explore, features
from .sources import csv_tables, datasets
from .workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]
LIMIT = learn.THRESHOLD
DIGITS = 9
# Few users of the derived tables reorder only, so the habit queries also run
# at a share of reorder-only orders that some users reach.
LENIENT = 0.25

QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Workspace], DataFrame], name: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(workspace(spark, sf_dir))

    QUERIES[name or build.__name__] = run
    return build


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _prior_orders(ws: Workspace) -> DataFrame:
    return ws.tables["orders"].filter(F.col("eval_set") == "prior")


# reports that are functions of the tables alone
for _report in (
    explore.table_profile,
    explore.first_n_lines,
    explore.orders_per_user,
    explore.eval_set_rows,
    explore.eval_set_users,
    explore.max_order_hist,
    explore.orders_by_dow,
    explore.orders_by_hour,
    explore.dow_hour_counts,
    explore.days_gap_hist,
    explore.orders_by_number,
    explore.reorder_rate,
    explore.order_any_reorder,
    explore.basket_size_hist,
    explore.cart_pos_reorder,
    explore.dow_reorder,
    explore.hour_reorder,
    explore.dow_hour_reorder,
    explore.gap_reorder,
    explore.reorder_split,
    explore.top_products,
    explore.top_aisles,
    explore.department_share,
    explore.department_reorder,
    explore.aisle_reorder,
    explore.bestsellers,
    explore.popularity_reorder,
    explore.most_reordered,
    explore.first_in_cart,
    explore.portfolio_products,
    explore.portfolio_sales,
    explore.distinct_counts,
    explore.orders_reorder_mean,
    explore.always_reorder_users,
    features.purchase_ordinal,
    joins.prior_detail,
    joins.train_with_user,
    features.user_product_features,
):
    _query(lambda ws, report=_report: report(ws.tables), _report.__name__)


@_query
def table_preview(ws):
    return explore.table_preview(ws.tables["orders"], "order_id", n=5)


@_query
def days_gap_hist_all(ws):
    return explore.days_gap_hist(ws.tables, keep_null=True)


@_query
def organic_share(ws):
    return explore.organic_share(ws.tables, "red")


@_query
def organic_reorder(ws):
    return explore.organic_reorder(ws.tables, "red")


@_query
def top_products_10(ws):
    return explore.top_products(ws.tables, 10)


@_query
def top_aisles_10(ws):
    return explore.top_aisles(ws.tables, 10)


@_query
def reordered_hist(ws):
    return ranking.histogram(ws.tables["prior"], "reordered")


@_query
def group_box_stats(ws):
    return groups.group_box_stats(
        ws.tables["orders"], "order_dow", "days_since_prior_order"
    )


@_query
def group_box_stats_by_mean(ws):
    return groups.group_box_stats(
        ws.tables["prior"], "product_id", "add_to_cart_order", "mean", ascending=False
    )


# rows, filters, joins


@_query
def filter_eval_set(ws):
    return ws.tables["orders"].filter(F.col("eval_set") != "prior")


@_query
def order_prior_sorted(ws):
    return joins.prior_detail(ws.tables).orderBy("user_id", "order_id")


@_query
def mostly_reorder_users(ws):
    return explore.always_reorder_users(ws.tables, LENIENT)


def _habit_user(ws, eval_set=None):
    return explore.strongest_habit(ws.tables, eval_set, LENIENT)


@_query
def habit_user_lines(ws):
    return explore.habit_user_lines(ws.tables, _habit_user(ws))


@_query
def orders_of_user(ws):
    return joins.orders_of_user(ws.tables, _habit_user(ws))


@_query
def train_order_of_user(ws):
    return explore.train_order_of_user(ws.tables, _habit_user(ws, "train"))


@_query
def habit_user_train(ws):
    users = explore.always_reorder_users(ws.tables, LENIENT)
    return explore.habit_user_train(ws.tables, users)


@_query
def lines_with_dims(ws):
    return joins.lines_with_dims(ws.tables["prior"], ws.tables)


@_query
def lines_with_dims_inner(ws):
    return joins.lines_with_dims(ws.tables["prior"], ws.tables, "inner")


@_query
def lines_with_orders(ws):
    return joins.lines_with_orders(ws.tables["train"], ws.tables)


@_query
def label_join(ws):
    pairs = features.user_product_features(ws.tables).select(*schema.PAIR_KEYS)
    return joins.label_join(pairs, ws.tables)


@_query
def eval_set_disjoint(ws):
    return matrix_ops.eval_set_disjoint(ws.tables)


@_query
def order_streak(ws):
    return features.order_streaks(ws.tables)


# group statistics


@_query
def group_stats_multi(ws):
    return groups.group_stats_multi(
        joins.prior_detail(ws.tables),
        ["user_id"],
        {
            "order_number": {"last_order": "max", "first_order": "min"},
            "product_id": {"n_lines": "count", "n_products": "nunique"},
            "reordered": {
                "n_reordered": "sum",
                "n_new": lambda c: F.count_if(c == 0),
            },
            "add_to_cart_order": {"mean_position": "mean", "median_position": "median"},
        },
    )


SECOND_LARGEST = GroupFunction(
    "second_largest",
    partial=lambda v: np.sort(np.append(v, [-np.inf, -np.inf]))[-2:],
    merge=lambda states: np.sort(states.ravel())[-2:],
    finish=lambda two: two[0] if np.isfinite(two[0]) else two[1],
)


@_query
def group_stats_own_function(ws):
    """A function of the caller beside built-in ones."""
    return groups.group_stats_multi(
        joins.prior_detail(ws.tables),
        ["user_id"],
        {"add_to_cart_order": {"n_lines": "count", "last_place": "max", "last_but_one": SECOND_LARGEST}},
    )


@_query
def group_stats_multi_joined(ws):
    return groups.group_stats_multi(
        ws.tables["train"],
        ["product_id"],
        {"reordered": {"reorder_mean": "mean", "n_lines": "count"}},
        only_new=False,
    )


@_query
def group_stats_single(ws):
    return groups.group_stats_single(
        ws.tables["prior"],
        ["product_id"],
        ["add_to_cart_order"],
        ["count", "sum", "mean", "min", "max", "median", "nunique"],
    )


@_query
def group_stats_two_keys(ws):
    return groups.group_stats_single(
        ws.tables["orders"],
        ["order_dow", "order_hour_of_day"],
        ["days_since_prior_order"],
        ["count", "mean"],
    )


@_query
def group_stats_joined(ws):
    return groups.group_stats_single(
        ws.tables["train"],
        ["order_id"],
        ["add_to_cart_order"],
        ["count", "mean"],
        keep_only_stats=False,
    )


# the matrix


@_query
def product_features(ws):
    return features.product_features(features.pair_stats(joins.prior_detail(ws.tables)))


@_query
def user_features(ws):
    pairs = features.pair_stats(joins.prior_detail(ws.tables))
    return features.user_features(ws.tables["orders"], pairs)


@_query
def feature_matrix(ws):
    return features.feature_matrix(ws.spark, ws.tables, ws.store)


@_query
def train_matrix(ws):
    return ws.train.select(*schema.MATRIX)


@_query
def test_matrix(ws):
    return ws.test.select(*schema.MATRIX)


@_query
def narrow_ints(ws):
    return encode.narrow_ints(ws.matrix.select(*schema.MATRIX))[1]


@_query
def narrow_matrix(ws):
    """The narrowed integer columns of the matrix, widened again for comparison,
    and beside them the types they had."""
    whole = ws.matrix.select(*schema.MATRIX)
    narrowed = encode.narrow_ints(whole)[0]
    fields = [f for f in narrowed.schema if isinstance(f.dataType, encode.INTEGERS)]
    types = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in fields))
    return narrowed.select(
        *[F.col(f.name).cast(whole.schema[f.name].dataType) for f in fields], F.lit(types).alias("types")
    )


@_query
def encode_aisle_department(ws):
    dims = ws.tables["products"].select("product_id", "aisle_id", "department_id")
    return encode.encode_labels(dims, ["aisle_id", "department_id"], ws.store)


@_query
def label_fill(ws):
    return matrix_ops.label_fill(ws.train).select(*schema.PAIR_KEYS, "reordered")


@_query
def clean_matrix(ws):
    kept = matrix_ops.clean_matrix(ws.train, schema.MODEL_FEATURES, "reordered")
    return kept.select(*schema.PAIR_KEYS, "_user_reorder_ratio", "reordered")


@_query
def user_folds(ws):
    return matrix_ops.user_folds(ws.train).select(*schema.PAIR_KEYS, "fold")


@_query
def threshold_flags(ws):
    limits = {"flag_202": 0.202, "flag_210": 0.21, "flag_500": 0.5}
    return ws.scored.select(
        *schema.PAIR_KEYS,
        "order_id",
        *[flag_above("score", v).alias(k) for k, v in limits.items()],
    )


# decoding and evaluation


@_query
def predicted_lists(ws):
    return decode.decode(ws.scored, LIMIT)


@_query
def submission(ws):
    lists = decode.decode(ws.scored.filter(F.col("eval_set") == "test"), LIMIT)
    return decode.submission(ws.tables["sample_submission"], lists)


@_query
def complete_test_lists(ws):
    """Every test order in the matrix, with its list or 'None'."""
    return decode.complete_lists(ws.scored.filter(F.col("eval_set") == "test"), LIMIT)


@_query
def ground_truth(ws):
    return ws.truth


def _train_lists(ws):
    return decode.complete_lists(ws.scored_train, LIMIT)


@_query
def order_f1(ws):
    return _rounded(metrics.order_f1(ws.truth, _train_lists(ws)), "f1")


@_query
def list_overlap(ws):
    return _rounded(metrics.order_f1_sets(ws.truth, _train_lists(ws)), "f1")


@_query
def mean_f1_lists(ws):
    return _rounded(metrics.mean_f1(ws.truth, _train_lists(ws)), "mean_f1")


@_query
def mean_f1_sets(ws):
    return _rounded(metrics.mean_f1_sets(ws.truth, _train_lists(ws)), "mean_f1")


def _folded(ws):
    return learn.folded_lists(matrix_ops.user_folds(ws.scored_train))


@_query
def cv_folds_union(ws):
    return _folded(ws)


@_query
def cv_fold_scores(ws):
    return _rounded(metrics.fold_scores(ws.truth, _folded(ws)), "f1")


@_query
def regression_metrics(ws):
    rows = matrix_ops.label_fill(ws.scored_train)
    return _rounded(
        metrics.regression_metrics(rows, "reordered", "score"), "rmse", "rmsle", "r2"
    )


@_query
def binary_metrics(ws):
    rows = matrix_ops.label_fill(ws.scored_train)
    return _rounded(
        metrics.binary_metrics(rows, "reordered", "score", LIMIT), "log_loss", "f1"
    )


# segments


@_query
def user_aisle_counts(ws):
    return segments.user_aisle_counts(ws.tables)


@_query
def user_aisle_crosstab(ws):
    return segments.user_aisle_crosstab(ws.aisle_counts, ws.store)


def _profile(ws):
    return segments.cluster_profile(ws.aisle_counts, ws.fixed_segments)


@_query
def cluster_profile(ws):
    return _profile(ws)


@_query
def cluster_top_aisles(ws):
    return segments.cluster_top_aisles(_profile(ws))


@_query
def cluster_next_aisles(ws):
    return segments.cluster_top_aisles(_profile(ws), 11, 15)


@_query
def cluster_share(ws):
    best = explore.top_aisles(ws.tables, 8)
    return _rounded(segments.cluster_share(_profile(ws), best), "percent")


@_query
def user_pca(ws):
    return segments.user_pca(ws.aisle_counts, store=ws.store)[0]


@_query
def aisle_co_occurrence(ws):
    """Sums over the users of the products of their counts in two aisles."""
    codes = segments.aisle_codes(ws.aisle_counts, ws.store)
    found = segments.co_occurrence(segments.sparse_table(ws.aisle_counts, codes))
    for side in ("i", "j"):
        found = found.join(codes.select(F.col("code").alias(side), F.col("aisle").alias(f"aisle_{side}")), side)
    return found.select("aisle_i", "aisle_j", "total")


@_query
def pca_variance(ws):
    """What holds of all components: their variances add up to the variance of the
    counts."""
    scores = segments.user_pca(ws.aisle_counts, k=10_000, store=ws.store)[0]
    spread = scores.select("user_id", F.posexplode("pc").alias("component", "score")).groupBy("component")
    each = spread.agg(F.var_samp("score").alias("variance"))
    return each.agg(F.count("*").alias("n_components"), F.round(F.sum("variance"), 6).alias("total_variance"))


@_query
def pca_pair(ws):
    return segments.pca_pair(ws.components)


@_query
def user_clusters(ws):
    return segments.user_clusters(segments.pca_pair(ws.components))[0]


@_query
def clustered_users(ws):
    """What holds of any clustering: every user with purchases in one of four."""
    rows = user_clusters(ws)
    return rows.agg(
        F.count("*").alias("n_users"),
        F.count_distinct("user_id").alias("n_distinct"),
        F.count_if(~F.col("segment").between(0, 3)).alias("n_outside"),
    )


@_query
def cluster_profile_kmeans(ws):
    return segments.cluster_profile(ws.aisle_counts, ws.clusters)


@_query
def cluster_top_aisles_kmeans(ws):
    return segments.cluster_top_aisles(
        segments.cluster_profile(ws.aisle_counts, ws.clusters)
    )


# models


@_query
def gbt_train(ws):
    """Submission lists of a model fitted on the whole train matrix."""
    sample = ws.tables["sample_submission"]
    return learn.gbt_submission(ws.train, ws.test, sample, ws.store, model=ws.booster)


@_query
def gbt_categorical_lists(ws):
    """Lists of every test order from the categorical model."""
    scored = learn.gbt_categorical(ws.train, ws.test, validate=False, ledger=ws.ledger)[1]
    return decode.complete_lists(scored, LIMIT)


@_query
def gbt_score(ws):
    return learn.gbt_score(ws.booster, ws.test_vectors)


@_query
def gbt_score_range(ws):
    """What holds of any model's scores: one per test row, none missing, all
    probabilities."""
    rows = learn.gbt_score(ws.booster, ws.test_vectors)
    pairs = rows.select(*schema.PAIR_KEYS).distinct().count()
    return rows.agg(
        F.count("score").alias("n_scores"),
        F.lit(pairs).cast("bigint").alias("n_pairs"),
        F.count_if(~F.col("score").between(0, 1)).alias("n_outside"),
    )


@_query
def feature_importance(ws):
    return learn.feature_importance(ws.booster, ws.vectors)


@_query
def gbt_cv_f1(ws):
    return learn.gbt_cv_f1(ws.train, ws.truth, ws.store, ledger=ws.ledger)


@_query
def gbt_round_sweep(ws):
    return learn.gbt_round_sweep(ws.train, ws.truth, ws.store, ledger=ws.ledger)


@_query
def gbt_rounds(ws):
    return learn.gbt_rounds(ws.vectors, **learn.SEARCH, ledger=ws.ledger)[1]


@_query
def gbt_categorical(ws):
    seen, held = matrix_ops.split_rows(ws.train, ["user_id"])
    return learn.gbt_categorical(seen, held, ledger=ws.ledger)[1]


@_query
def gbt_categorical_cv_f1(ws):
    return learn.gbt_cv_f1(ws.train, ws.truth, ws.store, categorical=["aisle_id"], ledger=ws.ledger)


@_query
def ridge_grid(ws):
    return learn.ridge_grid(ws.vectors)[1]


@_query
def ridge_grid_f1(ws):
    """The grid judged by the mean F1 of the decoded lists."""
    return learn.ridge_grid(ws.vectors, truth=ws.truth)[1]


@_query
def product_sums(ws):
    """Sums of products of whole-numbered columns per fold of users."""
    columns = ["_up_order_count", "_up_first_order_number", "_user_total_orders", "_prod_tot_cnts"]
    filled = matrix_ops.label_fill(ws.train).select(*schema.PAIR_KEYS, schema.LABEL, *columns)
    vectors = learn.vectorize(filled, columns, nullable=[])
    return linear.product_sums(matrix_ops.user_folds(vectors))


@_query
def lasso_errors(ws):
    """Cross-validated error of each penalty of the lasso."""
    search = learn.LassoSearch()
    rows = list(zip(search.penalties, search.errors(ws.vectors)))
    return ws.spark.createDataFrame(rows, "penalty double, rmse double")


def _learners(ws, *names):
    every = learn.base_learners(ws.ridge_unit, ws.trees)
    return {n: every[n] for n in names}


@_query
def base_learners(ws):
    """The test rows scored by every base learner of the first layer."""
    first = ("boosted_classifier", "forest_deep", "forest_wide", "boosted", "ridge", "lasso", "elastic", "lasso_cv")
    models = _learners(ws, *first)
    data = ws.ledger.fingerprint(ws.vectors)
    fits = [lambda e=e: learn.fitted(e, ws.vectors, ws.ledger, data) for e in models.values()]
    scored = ws.test_vectors
    for name, model in zip(models, learn.concurrently(fits)):
        scored = learn.score_with(model, scored, name)
    return scored.drop(learn.FEATURES)


@_query
def oof_stack(ws):
    models = _learners(ws, "boosted", "ridge")
    meta = _learners(ws, "ridge")["ridge"]
    return stacking.oof_stack(
        ws.vectors, ws.test_vectors, models, meta, ws.store, with_original=False, ledger=ws.ledger
    ).test


@_query
def oof_stack_scores(ws):
    models = _learners(ws, "ridge", "lasso", "lasso_cv")
    meta = _learners(ws, "ridge")["ridge"]
    return stacking.oof_stack(
        ws.vectors, ws.test_vectors, models, meta, ws.store, ledger=ws.ledger
    ).scores


@_query
def oof_stack_train(ws):
    models = _learners(ws, "ridge", "lasso")
    meta = _learners(ws, "ridge")["ridge"]
    return stacking.oof_stack(
        ws.vectors, ws.test_vectors, models, meta, ws.store, ledger=ws.ledger
    ).oof


@_query
def oof_stack_folds(ws):
    """What holds of any stack: every train row once, in its fold, scored."""
    rows = oof_stack_train(ws)
    missing = F.count_if(F.col("ridge").isNull() | F.col("lasso").isNull())
    return rows.groupBy("fold").agg(F.count("*").alias("n_rows"), missing.alias("n_missing"))


@_query
def oof_stack_three_levels(ws):
    models = _learners(ws, "ridge", "lasso")
    extra = _learners(ws, "boosted", "forest_second")
    second = {"second_boosted": extra["boosted"], "second_forest": extra["forest_second"]}
    meta = _learners(ws, "ridge")["ridge"]
    return stacking.oof_stack(
        ws.vectors, ws.test_vectors, models, meta, ws.store, second=second, ledger=ws.ledger
    ).test


@_query
def oof_stack_grid(ws):
    """Stack whose meta-model is a ridge regression with the penalty of the largest
    mean order F1."""
    models = _learners(ws, "boosted_classifier", "ridge", "lasso")

    def meta(vectors):
        return learn.ridge_grid(vectors, truth=ws.truth)[0]

    return stacking.oof_stack(
        ws.vectors, ws.test_vectors, models, meta, ws.store, with_original=False, ledger=ws.ledger
    ).test


@_query
def oof_stack_extra(ws):
    """Stack with a column the base models do not see, and a boosted meta-model
    whose number of rounds is searched."""
    pair = segments.pca_pair(ws.components).select("user_id", F.col("x").alias("taste"))

    def with_taste(vectors):
        return vectors.join(pair, "user_id", "left").fillna(0.0, ["taste"])

    def meta(vectors):
        rounds, _ = learn.gbt_rounds(vectors, **learn.SEARCH, ledger=ws.ledger)
        return learn.gbt_train(vectors, {"maxIter": rounds}, ws.ledger)

    models = _learners(ws, "ridge", "lasso")
    return stacking.oof_stack(
        with_taste(ws.vectors),
        with_taste(ws.test_vectors),
        models,
        meta,
        ws.store,
        extra_cols=["taste"],
        ledger=ws.ledger,
    ).test


@_query
def split_rows(ws):
    held = matrix_ops.split_rows(ws.train, schema.PAIR_KEYS)[1]
    return held.select(*schema.PAIR_KEYS)


# sources and sinks


def _csv_copy(ws: Workspace) -> str:
    """The basket tables as CSV files, as a user would hold them."""
    folder = ws.store.path("csv")
    for name, (file, _) in schema.CSV_FILES.items():
        _write_csv(ws.tables[name].select(*_columns(name)), f"{folder}/{file}")
    return folder


def _write_csv(frame: DataFrame, path: str) -> None:
    frame.write.options(header=True, quote='"', escape='"').csv(path)


def _columns(table: str) -> list[str]:
    return schema.CSV_FILES[table][1].fieldNames()


@_query
def load_tables(ws):
    loaded = csv_tables.load_tables(ws.spark, _csv_copy(ws))
    return loaded["orders"]


@_query
def load_tables_profile(ws):
    return explore.table_profile(csv_tables.load_tables(ws.spark, _csv_copy(ws)))


@_query
def inferred_csv(ws):
    path = ws.store.path("inferred.csv")
    _write_csv(ws.tables["products"], path)
    return csv_tables.scan_csv(ws.spark, path)


@_query
def dataset_roundtrip(ws):
    path = ws.store.path("dataset")
    datasets.save_dataset(path, ws.train.select(*schema.MATRIX), ws.test)
    return datasets.load_dataset(ws.spark, path)[0]


@_query
def matrix_cache(ws):
    path = ws.store.path("matrix_cache")
    return datasets.cached(ws.spark, path, lambda: ws.matrix.select(*schema.MATRIX))


@_query
def submission_csv(ws):
    path = ws.store.path("submission.csv")
    datasets.write_submission(submission(ws), path)
    return csv_tables.load_order_lists(ws.spark, path)


@_query
def submission_scored_csv(ws):
    """The submission under a name with the mean F1 of the train orders' lists."""
    score = metrics.mean_f1(ws.truth, decode.complete_lists(ws.scored_train, LIMIT)).first()[0]
    path = datasets.write_scored_submission(submission(ws), ws.store.path("submissions"), round(score, 5))
    return csv_tables.load_order_lists(ws.spark, path)


@_query
def ground_truth_csv(ws):
    path = ws.store.path("truth.csv")
    datasets.write_ground_truth(ws.truth, path)
    return csv_tables.load_order_lists(ws.spark, path)


@_query
def sample_rows(ws):
    """Five aisles drawn at random."""
    return datasets.sample_rows(ws.tables["aisles"], 5)


@_query
def shuffled_train(ws):
    """The whole train matrix in random order."""
    return datasets.sample_rows(ws.train.select(*schema.MATRIX))

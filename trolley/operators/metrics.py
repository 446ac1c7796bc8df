"""Evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio


def _items(products: str) -> Column:
    """The list as tokens; 'None' counts as the one item '-1'."""
    return F.split(F.replace(F.col(products), F.lit("None"), F.lit("-1")), " ")


def _paired(truth: DataFrame, pred: DataFrame, *keep: str) -> DataFrame:
    """Predicted orders that have a truth."""
    return pred.select("order_id", *keep, _items("products").alias("_pred")).join(
        truth.select("order_id", _items("products").alias("_truth")), "order_id"
    )


def order_f1(truth: DataFrame, pred: DataFrame, *keep: str) -> DataFrame:
    """(order_id, f1) and the ``keep`` columns of ``pred``. Precision divides by
    the length of the predicted list as written: a repeated id lowers it."""
    hits = F.size(F.array_intersect("_pred", "_truth"))
    precision = hits / F.size("_pred")
    recall = hits / F.size("_truth")
    score = F.when(hits > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return _paired(truth, pred, *keep).select("order_id", *keep, score.alias("f1"))


def order_f1_sets(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """(order_id, tp, fp, fn, f1) over the lists taken as sets."""
    sets = _paired(truth, pred).select(
        "order_id",
        F.size(F.array_intersect("_pred", "_truth")).alias("tp"),
        F.size(F.array_except("_pred", "_truth")).alias("fp"),
        F.size(F.array_except("_truth", "_pred")).alias("fn"),
    )
    return sets.withColumn(
        "f1", ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fn") + F.col("fp"))
    )


def mean_f1(truth: DataFrame, pred: DataFrame) -> DataFrame:
    return order_f1(truth, pred).agg(F.avg("f1").alias("mean_f1"))


def mean_f1_sets(truth: DataFrame, pred: DataFrame) -> DataFrame:
    return order_f1_sets(truth, pred).agg(F.avg("f1").alias("mean_f1"))


def fold_scores(truth: DataFrame, folded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean F1 per fold, then the mean of the folds ('mean') and the F1 pooled
    over all orders ('pooled'). ``folded`` is (fold, order_id, products); with
    the columns ``by`` in it, all of this for each of their values."""
    keys = list(by)
    per_fold = order_f1(truth, folded, *keys, "fold").groupBy(*keys, "fold").agg(
        F.sum("f1").alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    by_fold = per_fold.select(
        *keys, F.col("fold").cast("string").alias("fold"), (F.col("_sum") / F.col("_n")).alias("f1")
    )
    overall = per_fold.groupBy(*keys).agg(
        F.avg(F.col("_sum") / F.col("_n")).alias("mean"),
        (F.sum("_sum") / F.sum("_n")).alias("pooled"),
    ).unpivot(keys, ["mean", "pooled"], "fold", "f1")
    return by_fold.unionByName(overall)


def regression_terms(y: str, yhat: str, names: Sequence[str]) -> list[Column]:
    """The named aggregates among rmse, rmsle and r2."""
    error = F.pow(F.col(y) - F.col(yhat), 2)
    log_error = F.pow(F.log1p(F.col(y)) - F.log1p(F.col(yhat)), 2)
    spread = F.var_pop(y) * F.count(y)
    terms = {
        "rmse": F.sqrt(F.avg(error)),
        "rmsle": F.sqrt(F.avg(log_error)),
        "r2": 1 - F.try_divide(F.sum(error), spread),
    }
    return [terms[n].alias(n) for n in names]


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row: rmse, rmsle, r2."""
    return df.agg(*regression_terms(y, yhat, ["rmse", "rmsle", "r2"]))


def binary_metrics(
    df: DataFrame, y: str, score: str, threshold: float = 0.5, eps: float = 1e-15
) -> DataFrame:
    """One row: log_loss of the score and F1 of the thresholded score."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    loss = -F.when(F.col(y) == 1, F.log(p)).otherwise(F.log(1 - p))
    hit = F.col(score) > threshold
    true = F.col(y) == 1
    counts = 2 * F.count_if(hit & true), F.count_if(hit) + F.count_if(true)
    return df.agg(F.avg(loss).alias("log_loss"), ratio(*counts).alias("f1"))

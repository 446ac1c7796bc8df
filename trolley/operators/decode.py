"""Scores to product lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag_above
from ..functions.stats import STATS

NONE = "None"


def decode(scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """(order_id, products): the ids scored above ``threshold``, in ascending
    order, space-joined. Orders with no such product are absent."""
    return (
        scored.filter(flag_above(score, threshold) == 1)
        .groupBy("order_id")
        .agg(STATS["join_set"](F.col("product_id")).alias("products"))
    )


def submission(orders: DataFrame, lists: DataFrame) -> DataFrame:
    """One list per order id, 'None' where nothing was predicted."""
    return orders.select("order_id").join(lists, "order_id", "left").select(
        "order_id", F.coalesce("products", F.lit(NONE)).alias("products")
    )


def complete_lists(
    scored: DataFrame, threshold: float, score: str = "score", keep: Sequence[str] = ()
) -> DataFrame:
    """Every scored order with its list or 'None', in one grouping. ``keep``
    are columns that depend on the order alone."""
    above = F.when(F.col(score) > threshold, F.col("product_id"))
    joined = STATS["join_set"](above)
    return scored.groupBy("order_id", *keep).agg(
        F.when(joined == "", NONE).otherwise(joined).alias("products")
    )


def staged_lists(
    scored: DataFrame, threshold: float, n: int, scores: str = "scores", keep: Sequence[str] = ()
) -> DataFrame:
    """(order_id, keep, at, products): :func:`complete_lists` for each of the ``n``
    ``scores`` of a row. A row is grouped once, with the places of its scores above
    the threshold; it is not repeated for each score."""
    above = F.filter(
        F.transform(scores, lambda s, i: F.when(s > threshold, i)), lambda i: i.isNotNull()
    )
    rows = scored.select("order_id", *keep, F.struct("product_id", above.alias("at")).alias("_row"))
    chosen = F.when(F.size("_row.at") > 0, F.col("_row"))
    grouped = rows.groupBy("order_id", *keep).agg(F.collect_list(chosen).alias("_rows"))

    def listed(i: Column) -> Column:
        mine = F.filter("_rows", lambda r: F.array_contains(r["at"], i))
        ids = F.sort_array(F.array_distinct(F.transform(mine, lambda r: r["product_id"])))
        known = F.filter(ids, lambda v: v.isNotNull())
        return F.concat_ws(" ", F.transform(known, lambda v: v.cast("string")))

    each = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), listed)
    joined = F.col("_list")
    return grouped.select("order_id", *keep, F.posexplode(each).alias("at", "_list")).select(
        "order_id", *keep, "at", F.when(joined == "", NONE).otherwise(joined).alias("products")
    )


def ground_truth(train: DataFrame) -> DataFrame:
    """(order_id, products): reordered products of each train order in cart
    order, or 'None'. Orders without lines are absent."""
    kept = F.when(
        F.col("reordered") == 1, F.struct("add_to_cart_order", "product_id")
    )
    listed = F.concat_ws(
        " ",
        F.transform(
            F.array_sort(F.collect_list(kept)), lambda s: s["product_id"].cast("string")
        ),
    )
    return train.groupBy("order_id").agg(
        F.when(listed == "", NONE).otherwise(listed).alias("products")
    )

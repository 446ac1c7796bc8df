"""The per user-and-product training matrix.

The (user, product) aggregate is computed first; product and user statistics
are then derived from that smaller table: a product's first-time purchases are
its pairs, its second-time purchases the pairs bought at least twice. No window
over the order lines and no distinct count is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import ratio
from ..operators.encode import encode_labels
from ..operators.joins import Tables, label_join, prior_detail


WORD = 32  # order numbers in one word of a pair's bitmap


def _by_word(lines: DataFrame, width: int, *aggregates: Column) -> DataFrame:
    """Aggregates per (user, product) and run of ``width`` order numbers, all rows
    of a pair in one partition: what follows per pair shuffles nothing."""
    word = F.floor(F.col("order_number") / F.lit(width)).alias("_word")
    return lines.repartition(*schema.PAIR_KEYS).groupBy(*schema.PAIR_KEYS, word).agg(*aggregates)


def purchase_ordinal(tables: Tables, width: int = WORD) -> DataFrame:
    """Prior lines with ``_user_buy_product_times``: the how-manieth purchase
    of this product by this user, in order_number order. That is a line's place
    among the ``width`` order numbers of its word, after the lines of the pair's
    earlier words."""
    detail = prior_detail(tables).select(
        "user_id", "product_id", "order_id", "order_number"
    )
    listed = F.array_sort(F.collect_list(F.struct("order_number", "order_id"))).alias("_orders")
    words = _by_word(detail, width, listed)
    ahead = Window.partitionBy(*schema.PAIR_KEYS).orderBy("_word").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.size("_orders")).over(ahead), F.lit(0)).alias("_before")
    places = words.select(*schema.PAIR_KEYS, "_orders", before).select(
        *schema.PAIR_KEYS, "_before", F.posexplode("_orders").alias("_at", "_line")
    )
    return places.select(
        *schema.PAIR_KEYS,
        "_line.order_id",
        "_line.order_number",
        (F.col("_before") + F.col("_at") + 1).cast("bigint").alias("_user_buy_product_times"),
    )


def order_streaks(tables: Tables, width: int = WORD) -> DataFrame:
    """Length of the unbroken run of a user's most recent prior orders that
    contain the product; 0 when the last prior order lacks it. A pair's order
    numbers are bits of words of ``width``, the latest lowest: the streak are the
    trailing ones from the user's last order on, through as many words as are full."""
    bought = prior_detail(tables).select("user_id", "product_id", "order_number")
    bit = F.expr(f"shiftleft(1L, {width - 1} - order_number % {width})")
    words = _by_word(bought, width, F.bit_or(bit).alias("_bits"))
    pairs = words.groupBy(*schema.PAIR_KEYS).agg(
        F.sort_array(F.collect_list(F.struct("_word", "_bits")), asc=False).alias("_words")
    )
    last = (
        tables["orders"]
        .filter(F.col("eval_set") == "prior")
        .groupBy("user_id")
        .agg(F.max("order_number").alias("_last"))
    )

    def state(word: Column, top: Column, n: Column, more: Column) -> Column:
        return F.struct(
            word.cast("long").alias("word"), top.cast("int").alias("top"), n.cast("int").alias("n"), more.alias("more")
        )

    def step(s: Column, x: Column) -> Column:
        seen = F.call_function("shiftrightunsigned", x["_bits"], F.lit(width - 1) - s["top"])
        ones = F.bit_count(seen.bitwiseAND(F.bitwise_not(seen + 1)))
        on = state(s["word"] - 1, F.lit(width - 1), s["n"] + ones, ones == s["top"] + 1)
        return F.when(s["more"] & (x["_word"] == s["word"]), on).otherwise(
            state(s["word"], s["top"], s["n"], F.lit(False))
        )

    start = state(F.floor(F.col("_last") / width), F.col("_last") % width, F.lit(0), F.lit(True))
    return pairs.join(last, "user_id").select(
        *schema.PAIR_KEYS, F.aggregate("_words", start, step)["n"].alias("order_streak")
    )


def pair_stats(detail: DataFrame) -> DataFrame:
    """Statistics per (user, product); ``_reorders`` and ``_later_lines`` feed
    the product and user statistics."""
    return detail.groupBy(*schema.PAIR_KEYS).agg(
        F.count("order_number").alias("_up_order_count"),
        F.min("order_number").alias("_up_first_order_number"),
        F.max("order_number").alias("_up_last_order_number"),
        F.avg("add_to_cart_order").alias("_up_average_cart_position"),
        F.sum("reordered").alias("_reorders"),
        F.count_if(F.col("order_number") > 1).alias("_later_lines"),
    )


def user_product_features(tables: Tables) -> DataFrame:
    return pair_stats(prior_detail(tables)).select(
        *schema.PAIR_KEYS, *schema.PAIR_FEATURES
    )


def product_features(pairs: DataFrame) -> DataFrame:
    """Product statistics from :func:`pair_stats`."""
    first = "_prod_buy_first_time_total_cnt"
    counts = pairs.groupBy("product_id").agg(
        F.sum("_up_order_count").alias("_prod_tot_cnts"),
        F.sum("_reorders").alias("_prod_reorder_tot_cnts"),
        F.count(F.lit(1)).alias(first),
        F.count_if(F.col("_up_order_count") >= 2).alias("_prod_buy_second_time_total_cnt"),
    )
    return counts.withColumns(
        {
            "_prod_reorder_prob": ratio("_prod_buy_second_time_total_cnt", first),
            "_prod_reorder_ratio": ratio("_prod_reorder_tot_cnts", "_prod_tot_cnts"),
            "_prod_reorder_times": 1 + ratio("_prod_reorder_tot_cnts", first),
        }
    ).select("product_id", *schema.PRODUCT_FEATURES)


def user_features(orders: DataFrame, pairs: DataFrame) -> DataFrame:
    """User statistics and the user's last, non-prior order.

    Day gaps are summed per order, not per line. Users without prior lines or
    without a non-prior order are dropped.
    """
    per_order = (
        orders.filter(F.col("eval_set") == "prior")
        .groupBy("user_id")
        .agg(
            F.max("order_number").alias("_user_total_orders"),
            F.sum("days_since_prior_order").alias("_user_sum_days_since_prior_order"),
            F.avg("days_since_prior_order").alias("_user_mean_days_since_prior_order"),
        )
    )
    per_line = pairs.groupBy("user_id").agg(
        F.sum("_up_order_count").alias("_user_total_products"),
        F.count(F.lit(1)).alias("_user_distinct_products"),
        ratio(F.sum("_reorders"), F.sum("_later_lines")).alias("_user_reorder_ratio"),
    )
    last = orders.filter(F.col("eval_set") != "prior").select(
        "user_id",
        "order_id",
        "eval_set",
        F.col("days_since_prior_order").alias("time_since_last_order"),
    )
    return (
        per_order.join(per_line, "user_id")
        .withColumn(
            "_user_average_basket", ratio("_user_total_products", "_user_total_orders")
        )
        .join(last, "user_id")
        .select("user_id", *schema.USER_FEATURES, *schema.LAST_ORDER)
    )


def feature_matrix(spark: SparkSession, tables: Tables, store) -> DataFrame:
    """One row per (user, product) bought before: 30 columns.

    Label and streak are joined while the pair statistics are still partitioned
    on (user_id, product_id). The result is stored bucketed on user_id, at most
    a catalogue of rows per user, so line-level user statistics and the user
    join read co-located buckets; only order-level rows are shuffled. Product
    statistics, a stored table as long as the catalogue, are broadcast when
    their size allows.
    """
    streaks = tables["order_streaks"].select(*schema.PAIR_KEYS, "order_streak")
    labelled = label_join(pair_stats(prior_detail(tables)), tables).join(
        streaks, schema.PAIR_KEYS, "left"
    )
    buckets = store.buckets_for(tables["prior"].count())
    pairs = store.put_bucketed(labelled, "pairs", ["user_id"], buckets)
    users = user_features(tables["orders"], pairs)
    # codes are numbered over the products that reach the matrix: those bought
    # by a user with a last order
    ends = tables["orders"].filter(F.col("eval_set") != "prior").select("user_id")
    reached = (
        pairs.select(*schema.PAIR_KEYS)
        .join(ends, "user_id", "left_semi")
        .select("product_id")
        .distinct()
    )
    placed = reached.join(
        tables["products"].select("product_id", "aisle_id", "department_id"),
        "product_id",
        "left",
    )
    coded = encode_labels(store.put(placed, "placed"), ["aisle_id", "department_id"])
    products = store.put(
        product_features(pairs).join(coded, "product_id"), "product_features"
    )
    return assemble(pairs, products, users)


def assemble(pairs: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    total = F.col("_user_total_orders")
    count = F.col("_up_order_count")
    since_first = total - F.col("_up_first_order_number") + 1
    return (
        pairs.join(users, "user_id")
        .join(products, "product_id")
        .withColumns(
            {
                "_up_order_rate": ratio(count, total),
                "_up_order_since_last_order": total - F.col("_up_last_order_number"),
                "_up_order_rate_since_first_order": ratio(count, since_first),
            }
        )
        .select(*schema.MATRIX)
    )


def split_matrix(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of the matrix."""
    return (
        matrix.filter(F.col("eval_set") == "train"),
        matrix.filter(F.col("eval_set") == "test"),
    )

"""Exploratory reports: each takes the basket tables and returns a DataFrame.

Reports over products, aisles and departments count lines per product first
(combined map-side) and join names onto that catalogue-sized table; reports
over order attributes count lines per order first, a grouping that reads the
order_id buckets without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cap, name_flag, ratio
from ..operators.joins import Tables, lines_of_orders, lines_with_dims
from ..operators.ranking import ORDERS_PER_BLOCK, share, top_n

LINE_SETS = ("prior", "train")
HOURS = list(range(24))


def _count(name: str = "count"):
    return F.count(F.lit(1)).alias(name)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _per_set(tables: Tables, report) -> DataFrame:
    """``report`` over prior and train lines, labelled by ``line_set``."""
    return _union(
        [report(tables[s]).withColumn("line_set", F.lit(s)) for s in LINE_SETS]
    )


def _by_product(lines: DataFrame) -> DataFrame:
    """Lines and reorders per product: catalogue-sized."""
    return lines.groupBy("product_id").agg(
        _count("_lines"), F.sum("reordered").alias("_reorders")
    )


def _by_order(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(
        _count("_lines"), F.sum("reordered").alias("_reorders")
    )


def _mean_reordered(frame: DataFrame, *keys: str, name: str = "reordered") -> DataFrame:
    return frame.groupBy(*keys).agg(
        ratio(F.sum("_reorders"), F.sum("_lines")).alias(name)
    )


# orders ----------------------------------------------------------------------


def table_profile(tables: Tables) -> DataFrame:
    """Row and column count of every table."""
    return _union(
        [
            frame.agg(_count("n_rows")).select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.lit(len(frame.columns)).alias("n_columns"),
            )
            for name, frame in sorted(tables.items())
        ]
    )


def table_preview(frame: DataFrame, *keys: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order."""
    return frame.orderBy(*keys).limit(n)


def first_n_lines(
    tables: Tables, n: int = 300_000, width: int = ORDERS_PER_BLOCK
) -> DataFrame:
    """The first ``n`` prior lines in (order_id, cart position) order.

    Sorting for a limit this large would bring ``n`` lines of every partition
    to one task. Instead lines are counted per block of ``width`` order ids;
    whole blocks are kept by a filter, and only the block in which the n-th
    line falls is sorted.
    """
    prior = tables["prior"]
    block = F.floor(F.col("order_id") / F.lit(width)).alias("_block")
    before = F.sum("_lines").over(Window.orderBy("_block")) - F.col("_lines")
    cut = (
        prior.groupBy(block)
        .agg(_count("_lines"))
        .withColumn("_before", before)
        .filter(F.col("_before") < n)
        .orderBy(F.desc("_block"))
        .first()
    )
    if cut is None:
        return prior
    whole = prior.filter(F.col("order_id") < cut["_block"] * width)
    split = prior.filter(
        (F.col("order_id") >= cut["_block"] * width)
        & (F.col("order_id") < (cut["_block"] + 1) * width)
    )
    rest = split.orderBy("order_id", "add_to_cart_order").limit(n - cut["_before"])
    return whole.unionByName(rest)


def orders_per_user(tables: Tables) -> DataFrame:
    return tables["orders"].groupBy("user_id").agg(_count("n_orders"))


def eval_set_rows(tables: Tables) -> DataFrame:
    return tables["orders"].groupBy("eval_set").agg(_count("n_orders"))


def eval_set_users(tables: Tables) -> DataFrame:
    return tables["orders"].groupBy("eval_set").agg(
        F.count_distinct("user_id").alias("n_users")
    )


def max_order_hist(tables: Tables) -> DataFrame:
    """How many users have each number of orders."""
    per_user = tables["orders"].groupBy("user_id").agg(
        F.max("order_number").alias("max_order_number")
    )
    return per_user.groupBy("max_order_number").agg(_count("n_users"))


def orders_by_dow(tables: Tables) -> DataFrame:
    return tables["orders"].groupBy("order_dow").agg(_count("n_orders"))


def orders_by_hour(tables: Tables) -> DataFrame:
    return tables["orders"].groupBy("order_hour_of_day").agg(_count("n_orders"))


def _hour_grid(frame: DataFrame, value) -> DataFrame:
    """order_dow x hour grid; cells without orders are NULL."""
    grid = frame.groupBy("order_dow").pivot("order_hour_of_day", HOURS).agg(value)
    return grid.toDF("order_dow", *[f"h{h:02d}" for h in HOURS])


def dow_hour_counts(tables: Tables) -> DataFrame:
    return _hour_grid(tables["orders"], F.count("order_number"))


def days_gap_hist(tables: Tables, keep_null: bool = False) -> DataFrame:
    """Orders per day gap; first orders have none and are counted on request."""
    orders = tables["orders"]
    if not keep_null:
        orders = orders.filter(F.col("days_since_prior_order").isNotNull())
    return orders.groupBy("days_since_prior_order").agg(_count("n_orders"))


def orders_by_number(tables: Tables) -> DataFrame:
    prior = tables["orders"].filter(F.col("eval_set") == "prior")
    return prior.groupBy("order_number").agg(_count("n"))


# reorders --------------------------------------------------------------------


def reorder_rate(tables: Tables) -> DataFrame:
    return _per_set(
        tables,
        lambda lines: lines.agg(
            ratio(F.sum("reordered"), F.count(F.lit(1))).alias("reorder_rate")
        ),
    )


def order_any_reorder(tables: Tables) -> DataFrame:
    """Share of orders with no (0) and with some (1) reordered product."""

    def report(lines: DataFrame) -> DataFrame:
        capped = _by_order(lines).select(cap("_reorders", 1).cast("int").alias("reordered"))
        return share(capped.groupBy("reordered").agg(_count("n_orders")), "n_orders")

    return _per_set(tables, report)


def basket_size_hist(tables: Tables) -> DataFrame:
    """Orders per basket size, the largest cart position of the order."""

    def report(lines: DataFrame) -> DataFrame:
        sizes = lines.groupBy("order_id").agg(F.max("add_to_cart_order").alias("n_items"))
        return sizes.groupBy("n_items").agg(_count("n_orders"))

    return _per_set(tables, report)


def cart_pos_reorder(tables: Tables, last: int = 70) -> DataFrame:
    position = cap("add_to_cart_order", last).alias("add_to_cart_order_mod")
    return tables["prior"].groupBy(position).agg(F.avg("reordered").alias("reordered"))


def _train_orders_with_time(tables: Tables) -> DataFrame:
    return _by_order(tables["train"]).join(tables["orders"], "order_id", "left")


def dow_reorder(tables: Tables) -> DataFrame:
    lines = _train_orders_with_time(tables).filter(F.col("order_dow").isNotNull())
    return _mean_reordered(lines, "order_dow")


def hour_reorder(tables: Tables) -> DataFrame:
    lines = _train_orders_with_time(tables).filter(F.col("order_hour_of_day").isNotNull())
    return _mean_reordered(lines, "order_hour_of_day")


def dow_hour_reorder(tables: Tables) -> DataFrame:
    lines = _train_orders_with_time(tables).filter(F.col("order_dow").isNotNull())
    return _hour_grid(lines, ratio(F.sum("_reorders"), F.sum("_lines")))


def gap_reorder(tables: Tables) -> DataFrame:
    """Mean reorder flag per day gap, first orders (no gap) included."""
    return _mean_reordered(
        _train_orders_with_time(tables), "days_since_prior_order", name="mean_reorder"
    )


def reorder_split(tables: Tables) -> DataFrame:
    return share(tables["train"].groupBy("reordered").agg(_count()), "count")


# products, aisles, departments -------------------------------------------------


def _top_names(tables: Tables, column: str, n: int) -> DataFrame:
    named = lines_with_dims(_by_product(tables["prior"]), tables)
    counts = named.groupBy(column).agg(F.sum("_lines").alias("frequency_count"))
    return top_n(
        counts.filter(F.col(column).isNotNull()),
        "frequency_count",
        n,
        ties=False,
        tiebreak=[column],
    )


def top_products(tables: Tables, n: int = 20) -> DataFrame:
    return _top_names(tables, "product_name", n)


def top_aisles(tables: Tables, n: int = 20) -> DataFrame:
    return _top_names(tables, "aisle", n)


def department_share(tables: Tables) -> DataFrame:
    named = lines_with_dims(_by_product(tables["prior"]), tables)
    counts = named.groupBy("department").agg(F.sum("_lines").alias("n_lines"))
    counted = counts.filter(F.col("department").isNotNull())
    return share(counted, "n_lines").select(
        "department", "n_lines", (F.col("proportion") * 100).alias("percent")
    )


def department_reorder(tables: Tables) -> DataFrame:
    named = lines_with_dims(_by_product(tables["prior"]), tables)
    return _mean_reordered(named.filter(F.col("department").isNotNull()), "department")


def aisle_reorder(tables: Tables) -> DataFrame:
    named = lines_with_dims(_by_product(tables["prior"]), tables).filter(
        F.col("department_id").isNotNull() & F.col("aisle").isNotNull()
    )
    return _mean_reordered(named, "department_id", "aisle")


def _with_product(frame: DataFrame, tables: Tables, *columns: str) -> DataFrame:
    products = tables["products"]
    if columns:
        products = products.select("product_id", *columns)
    return frame.join(products, "product_id", "left")


def bestsellers(tables: Tables, n: int = 10) -> DataFrame:
    counts = _by_product(tables["train"]).select(
        "product_id", F.col("_lines").alias("count")
    )
    best = _with_product(top_n(counts, "count", n), tables, "product_name")
    return best.orderBy(F.desc("count"), "product_id")


def popularity_reorder(tables: Tables) -> DataFrame:
    return _by_product(tables["train"]).select(
        "product_id",
        ratio("_reorders", "_lines").alias("proportion_reordered"),
        F.col("_lines").alias("n"),
    )


def most_reordered(tables: Tables, more_than: int = 40, n: int = 10) -> DataFrame:
    sold = popularity_reorder(tables).filter(F.col("n") > more_than)
    best = _with_product(top_n(sold, "proportion_reordered", n), tables)
    return best.orderBy(F.desc("proportion_reordered"), "product_id")


def first_in_cart(tables: Tables, more_than: int = 10, n: int = 10) -> DataFrame:
    """Products most often put into the cart first, by the share of the
    product's own lines that are in position 1."""
    cells = tables["train"].groupBy("product_id", "add_to_cart_order").agg(_count())
    first = share(cells, "count", within=["product_id"], name="pct").filter(
        (F.col("add_to_cart_order") == 1) & (F.col("count") > more_than)
    )
    best = top_n(first.select("product_id", "pct", "count"), "pct", n)
    return _with_product(best, tables, "product_name").orderBy(F.desc("pct"), "product_id")


def _organic(tables: Tables, pattern: str) -> DataFrame:
    flag = name_flag("product_name", pattern, "organic", "not organic")
    return _with_product(_by_product(tables["train"]), tables, "product_name").withColumn(
        "organic", flag
    )


def organic_share(tables: Tables, pattern: str = "organic") -> DataFrame:
    counts = _organic(tables, pattern).groupBy("organic").agg(
        F.sum("_lines").alias("count")
    )
    return share(counts, "count")


def organic_reorder(tables: Tables, pattern: str = "organic") -> DataFrame:
    return _mean_reordered(_organic(tables, pattern), "organic", name="mean_reordered")


def portfolio_products(tables: Tables) -> DataFrame:
    """Number of products on offer per department and aisle."""
    return (
        tables["products"]
        .groupBy("department_id", "aisle_id")
        .agg(_count("n"))
        .join(tables["departments"], "department_id", "left")
        .join(tables["aisles"], "aisle_id", "left")
    )


def portfolio_sales(tables: Tables) -> DataFrame:
    """Lines sold per department and aisle, beside the products on offer."""
    cell = ["department_id", "aisle_id"]
    sales = (
        _with_product(_by_product(tables["train"]), tables, *cell)
        .groupBy(*cell)
        .agg(F.sum("_lines").alias("sumcount"))
    )
    return sales.join(portfolio_products(tables), cell, "left").withColumn(
        "onesize", F.lit(1)
    )


def distinct_counts(tables: Tables) -> DataFrame:
    """Distinct product names and aisles among the prior lines."""
    named = lines_with_dims(_by_product(tables["prior"]), tables, "inner")
    return named.agg(
        F.count_distinct("product_name").alias("n_product_names"),
        F.count_distinct("aisle").alias("n_aisles"),
    )


# customer habits ---------------------------------------------------------------


def orders_reorder_mean(tables: Tables, after: int = 2) -> DataFrame:
    """Mean reorder flag ``m`` and line count ``n`` of every order numbered
    above ``after``; orders without prior lines keep NULL."""
    means = _by_order(tables["prior"]).select(
        "order_id", ratio("_reorders", "_lines").alias("m"), F.col("_lines").alias("n")
    )
    later = tables["orders"].filter(F.col("order_number") > after)
    return means.join(later, "order_id", "right")


def always_reorder_users(tables: Tables, at_least: float = 1.0) -> DataFrame:
    """Users whose later prior orders hold reordered products only, in at
    least the given share of those orders. An order without lines counts in
    the denominator."""
    prior = orders_reorder_mean(tables).filter(F.col("eval_set") == "prior")
    return (
        prior.groupBy("user_id")
        .agg(F.count_if(F.col("m") == 1).alias("n_equal"), _count("_orders"))
        .withColumn("percent_equal", ratio("n_equal", "_orders"))
        .filter(F.col("percent_equal") >= at_least)
        .select("user_id", "n_equal", "percent_equal")
        .orderBy(F.desc("n_equal"), "user_id")
    )


def strongest_habit(
    tables: Tables, eval_set: str | None = None, at_least: float = 1.0
) -> DataFrame:
    """The user with the most reorder-only orders; with ``eval_set``, among
    users whose last order is in that set."""
    users = always_reorder_users(tables, at_least)
    if eval_set:
        ends = tables["orders"].filter(F.col("eval_set") == eval_set)
        users = users.join(ends, "user_id", "left_semi")
    return users.orderBy(F.desc("n_equal"), "user_id").limit(1).select("user_id")


def habit_user_lines(tables: Tables, users: DataFrame | None = None) -> DataFrame:
    """Prior lines of the later orders of the given (strongest-habit) user."""
    users = strongest_habit(tables) if users is None else users
    later = tables["orders"].filter(F.col("order_number") > 2)
    chosen = later.join(users, "user_id", "left_semi")
    return _with_product(lines_of_orders(tables["prior"], chosen), tables, "product_name")


def train_order_of_user(tables: Tables, users: DataFrame | None = None) -> DataFrame:
    users = strongest_habit(tables, eval_set="train") if users is None else users
    train = tables["orders"].filter(F.col("eval_set") == "train")
    return train.join(users, "user_id", "left_semi")


def habit_user_train(tables: Tables, users: DataFrame | None = None) -> DataFrame:
    """Lines of the train order of the given (strongest-habit) user."""
    order = train_order_of_user(tables, users)
    return _with_product(lines_of_orders(tables["train"], order), tables, "product_name")

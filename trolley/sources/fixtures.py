"""Basket tables derived from star-schema order tables.

Every customer becomes a user, whose last order is the train or test order.
Parts of one brand and type are one product, so that repurchases occur; brands
are aisles, and five consecutive brands a department. Every order and every
order line is kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import position_in_group
from ..plans.features import order_streaks
from ..schema import CSV_FILES
from .store import Store

BRANDS_PER_DEPARTMENT = 5


def numbered_orders(orders: DataFrame) -> DataFrame:
    """Orders with their number per user, eval set and day gap. Customers are
    numbered day by day, so that the largest sort is one day of a customer."""
    source = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("_at"),
        F.to_date("o_orderdate").alias("_day"),
    )
    placed = position_in_group(
        source,
        ["user_id"],
        ["_at", "order_id"],
        {"_d": F.unix_date("_day")},
        position="_rn",
        size="_n",
        previous=("_day", "_prev"),
    )
    return placed.select(
        "order_id",
        "user_id",
        F.when(F.col("_rn") < F.col("_n"), "prior")
        .when(F.col("user_id") % 3 == 0, "test")
        .otherwise("train")
        .alias("eval_set"),
        F.col("_rn").cast("int").alias("order_number"),
        (F.dayofweek("_day") - 1).cast("int").alias("order_dow"),
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        (F.datediff("_day", "_prev") % 31).cast("double").alias("days_since_prior_order"),
    )


def order_lines(
    lineitem: DataFrame, parts: DataFrame, orders: DataFrame, buckets: int
) -> DataFrame:
    """One line per (order, product) with cart position and reorder flag.
    ``parts`` gives the product_id of each part_key."""
    sold = lineitem.join(parts, F.col("l_partkey") == F.col("part_key")).select(
        F.col("l_orderkey").alias("order_id"), "product_id", "l_linenumber"
    )
    numbered = orders.select("order_id", "user_id", "order_number", "eval_set")
    first_bought = (
        sold.select("order_id", "product_id")
        .join(numbered.select("order_id", "user_id", "order_number"), "order_id")
        .groupBy("user_id", "product_id")
        .agg(F.min("order_number").alias("_first"))
    )
    # one order's lines fit one task
    cart = Window.partitionBy("order_id").orderBy("_ln", "product_id")
    lines = (
        sold.repartition(buckets, "order_id")
        .groupBy("order_id", "product_id")
        .agg(F.min("l_linenumber").alias("_ln"))
        .join(numbered, "order_id")
        .withColumn("add_to_cart_order", F.row_number().over(cart))
    )
    return lines.join(first_bought, ["user_id", "product_id"]).select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("_first") < F.col("order_number")).cast("int").alias("reordered"),
        "eval_set",
    )


def _brand():
    return F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("int")


def _department_id():
    return F.floor((F.col("aisle_id") - 1) / BRANDS_PER_DEPARTMENT).cast("int") + 1


class BasketTables(Mapping):
    """The eight basket tables by name, each derived and stored when first
    asked for. Orders and both line tables are bucketed on order_id, so joining
    and grouping on it reads without a shuffle."""

    def __init__(self, spark: SparkSession, sf_dir: str, store: Store):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.store = store

    def __getitem__(self, name: str) -> DataFrame:
        if name not in CSV_FILES:
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self) -> Iterator[str]:
        return iter(CSV_FILES)

    def __len__(self) -> int:
        return len(CSV_FILES)

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    @cached_property
    def _buckets(self) -> int:
        return self.store.buckets_for(self._read("lineitem").count())

    @cached_property
    def orders(self) -> DataFrame:
        numbered = numbered_orders(self._read("orders"))
        return self.store.put_bucketed(numbered, "orders", ["order_id"], self._buckets)

    @cached_property
    def _lines(self) -> DataFrame:
        parts = self._read("part").select("p_partkey", "p_type", _brand().alias("aisle_id"))
        parts = parts.join(self._kinds, ["aisle_id", "p_type"]).select(
            F.col("p_partkey").alias("part_key"), "product_id"
        )
        parts = self.store.put(parts, "parts")
        lines = order_lines(self._read("lineitem"), parts, self.orders, self._buckets)
        return self.store.put_bucketed(
            lines, "lines", ["order_id"], self._buckets, ["eval_set"]
        )

    def _lines_of(self, eval_set: str) -> DataFrame:
        return self._lines.filter(F.col("eval_set") == eval_set).drop("eval_set")

    @cached_property
    def prior(self) -> DataFrame:
        return self._lines_of("prior")

    @cached_property
    def train(self) -> DataFrame:
        return self._lines_of("train")

    @cached_property
    def _kinds(self) -> DataFrame:
        """The products: brands by types, a few however many parts there are."""
        kinds = (
            self._read("part")
            .groupBy(_brand().alias("aisle_id"), "p_type")
            .agg(F.min_by("p_name", "p_partkey").alias("product_name"))
        )
        along = Window.orderBy("aisle_id", "p_type")  # brands by types
        return self.store.put(
            kinds.withColumn("product_id", F.row_number().over(along).cast("int")), "kinds"
        )

    @cached_property
    def aisles(self) -> DataFrame:
        return self._kinds.select("aisle_id").distinct().select(
            "aisle_id", F.concat(F.lit("Brand#"), F.col("aisle_id")).alias("aisle")
        )

    @cached_property
    def departments(self) -> DataFrame:
        last = F.col("department_id") * BRANDS_PER_DEPARTMENT
        name = F.concat(
            F.lit("Brand#"), last - (BRANDS_PER_DEPARTMENT - 1), F.lit("-"), last
        )
        numbers = self._kinds.select(_department_id().alias("department_id")).distinct()
        return numbers.select("department_id", name.alias("department"))

    @cached_property
    def products(self) -> DataFrame:
        return self._kinds.select(
            "product_id", "product_name", "aisle_id", _department_id().alias("department_id")
        )

    @cached_property
    def sample_submission(self) -> DataFrame:
        test = self.orders.filter(F.col("eval_set") == "test")
        return test.select("order_id", F.lit("None").alias("products"))

    @cached_property
    def order_streaks(self) -> DataFrame:
        return self.store.put(order_streaks(self), "order_streaks")

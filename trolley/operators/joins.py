"""Equi-joins between the basket tables. Columns are pruned before each join;
the physical strategy is left to Catalyst and AQE."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def prior_detail(tables: Tables) -> DataFrame:
    """Prior lines with their order's user, number and timing."""
    return tables["orders"].join(tables["prior"], "order_id")


def lines_with_dims(
    lines: DataFrame, tables: Tables, how: str = "left"
) -> DataFrame:
    """Order lines with product, aisle and department names."""
    return (
        lines.join(tables["products"], "product_id", how)
        .join(tables["aisles"], "aisle_id", how)
        .join(tables["departments"], "department_id", how)
    )


def lines_with_orders(lines: DataFrame, tables: Tables) -> DataFrame:
    return lines.join(tables["orders"], "order_id", "left")


def train_with_user(tables: Tables) -> DataFrame:
    owners = tables["orders"].select("order_id", "user_id")
    return tables["train"].join(owners, "order_id", "left")


def label_join(pairs: DataFrame, tables: Tables) -> DataFrame:
    """Adds ``reordered``: 1 where the train order holds the product again,
    NULL otherwise."""
    labels = train_with_user(tables).select(
        "user_id", "product_id", F.nullif("reordered", F.lit(0)).alias("reordered")
    )
    return pairs.join(labels, ["user_id", "product_id"], "left")


def orders_of_user(tables: Tables, users: DataFrame) -> DataFrame:
    """Orders of the given users (one column, user_id)."""
    return tables["orders"].join(users.select("user_id"), "user_id", "left_semi")


def lines_of_orders(lines: DataFrame, order_ids: DataFrame) -> DataFrame:
    """Lines whose order is among ``order_ids``."""
    return lines.join(order_ids.select("order_id"), "order_id", "left_semi")

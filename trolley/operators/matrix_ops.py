"""Row and column preparation of the training matrix."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import Tables


def label_fill(matrix: DataFrame, label: str = "reordered") -> DataFrame:
    """Missing label -> 0."""
    return matrix.withColumn(label, F.coalesce(F.col(label), F.lit(0)))


def clean_matrix(matrix: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows complete in every feature. Infinite and NaN values count as
    missing. The label is filled first, or every negative row would go."""
    floating = (T.DoubleType, T.FloatType)
    fixes = {}
    for f in features:
        if isinstance(matrix.schema[f].dataType, floating):
            v = F.col(f)
            fixes[f] = F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)
    return label_fill(matrix, label).withColumns(fixes).dropna(subset=list(features))


def user_folds(df: DataFrame, k: int = 4) -> DataFrame:
    """Adds ``fold`` = user_id mod k: a user's rows stay in one fold."""
    return df.withColumn("fold", F.pmod(F.col("user_id"), F.lit(k)).cast("int"))


def hash_folds(df: DataFrame, keys: Sequence[str], k: int, seed: int) -> DataFrame:
    """Adds ``fold`` in 0..k-1 from a hash of the keys: the assignment is
    shuffled, yet survives recomputation and any partitioning."""
    return df.withColumn("fold", (drawn(keys, seed) % k).cast("int"))


def drawn(keys: Sequence[str], seed: int) -> Column:
    """A number below 2^48 from the keys: the head of an MD5 sum, which any
    engine can repeat."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("bigint")


def split_rows(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.25, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) rows, drawn by a hash of the keys."""
    steps = 1_000_000
    held = drawn(keys, seed) % steps < F.lit(round(test_size * steps))
    return df.filter(~held), df.filter(held)


def eval_set_disjoint(tables: Tables) -> DataFrame:
    """One row: how many order ids two of the sets (prior lines, train lines,
    test orders) share. All are 0 in sound data."""
    names = ["prior", "train", "test"]
    test = tables["orders"].filter(F.col("eval_set") == "test")
    tagged = None
    for name, frame in zip(names, [tables["prior"], tables["train"], test]):
        ids = frame.select("order_id", *[F.lit(n == name).alias(n) for n in names])
        tagged = ids if tagged is None else tagged.unionByName(ids)
    found = tagged.groupBy("order_id").agg(*[F.bool_or(n).alias(n) for n in names])
    return found.agg(
        F.count(F.lit(1)).alias("n_orders"),
        *[
            F.count_if(F.col(a) & F.col(b)).alias(f"{a}_{b}")
            for a, b in combinations(names, 2)
        ],
    )

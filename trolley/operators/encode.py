"""Label encoding and integer narrowing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import Store
from .ranking import position_in_group, range_blocks

SHORT_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)
INTEGERS = (*SHORT_INTEGERS, T.LongType)
VALUES_PER_BLOCK = 1 << 16


def label_codes(df: DataFrame, column: str, store=None) -> DataFrame:
    """(column, code): the distinct values of ``column``, numbered 0..k-1 in
    ascending order. Numbers order as numbers, strings by code point.

    Numbered in blocks: 65,536 consecutive integers of up to 32 bits, hence at
    most as many blocks; for other types one even range of the sorted values.
    """
    values = df.filter(F.col(column).isNotNull()).select(column).distinct()
    if isinstance(df.schema[column].dataType, SHORT_INTEGERS):
        block = F.floor(F.col(column) / F.lit(VALUES_PER_BLOCK))
    else:
        ranged = range_blocks(values, [column], store or Store(df.sparkSession))
        values, block = ranged, F.col("_block")
    placed = position_in_group(
        values, [], [column], {"_block": block}, position="_position"
    )
    return placed.select(column, (F.col("_position") - 1).cast("int").alias("code"))


def encode_labels(df: DataFrame, columns: Sequence[str], store=None) -> DataFrame:
    """Replaces each column by its code; NULL stays NULL. For a large ``df``
    give a store: the code tables are then written first, and the join strategy
    follows from their actual size."""
    for column in columns:
        codes = label_codes(df, column, store)
        if store is not None:
            codes = store.put(codes, f"codes_{column}")
        df = (
            df.join(codes, column, "left").drop(column).withColumnRenamed("code", column)
        )
    return df


# Greatest value and width in bytes of each signed type.
SIGNED = [("tinyint", 127, 1), ("smallint", 32767, 2), ("int", 2147483647, 4)]
WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}


def narrowing_report(df: DataFrame) -> DataFrame:
    """Per integer column: its range, the narrowest signed type that holds it
    and the bytes per value before and after. Columns with a negative or no
    value keep their type. One pass over the data for all columns."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, INTEGERS)]
    ranges = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column"),
                    F.min(f.name).cast("bigint").alias("min"),
                    F.max(f.name).cast("bigint").alias("max"),
                    F.lit(f.dataType.simpleString()).alias("source"),
                )
                for f in fields
            ]
        ).alias("_all")
    ).select(F.inline("_all"))
    target = F.when(F.col("min").isNull() | (F.col("min") < 0), F.col("source"))
    for name, greatest, _ in SIGNED:
        target = target.when(F.col("max") <= greatest, name)
    target = target.otherwise("bigint")

    def width(kind):
        sizes = F.create_map(*[F.lit(x) for pair in WIDTH.items() for x in pair])
        return sizes[kind]

    return (
        ranges.withColumn("target", target)
        .withColumn("bytes_before", width(F.col("source")))
        .withColumn("bytes_after", width(F.col("target")))
        .withColumn("adjusted", (F.col("min") >= 0) & F.col("min").isNotNull())
    )


def narrow_ints(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` with its integer columns narrowed, and the report. The report has
    one row per column; it is read on the driver to choose the casts."""
    report = narrowing_report(df)
    targets = {r["column"]: r["target"] for r in report.collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in targets.items()}), report

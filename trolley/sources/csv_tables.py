"""CSV scans with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema

# A malformed field must not become a NULL that a join then drops. The header is
# not checked against the types, which name the columns.
CSV_OPTIONS = {"header": True, "quote": "\"", "escape": "\"", "nanValue": "nan", "mode": "FAILFAST"}


def scan_csv(
    spark: SparkSession, path: str, types: T.StructType | None = None
) -> DataFrame:
    """Scan a CSV with a header; a quote inside a quoted field is doubled, and a
    field that does not fit its type is an error. Without ``types`` Spark
    infers them, at the price of a second pass over the file: for ad-hoc use
    only."""
    reader = spark.read.options(**CSV_OPTIONS)
    if types is None:
        return reader.option("inferSchema", True).csv(path)
    frame = reader.schema(types).csv(path)
    # a float NaN in the file means "missing": make it NULL at the boundary
    return frame.withColumns(
        {
            f.name: F.when(~F.isnan(f.name), F.col(f.name))
            for f in types.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )


def load_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The eight source tables of a basket dataset."""
    return {
        name: scan_csv(spark, f"{path.rstrip('/')}/{file}", types)
        for name, (file, types) in schema.CSV_FILES.items()
    }


def load_order_lists(spark: SparkSession, path: str) -> DataFrame:
    """A file of (order_id, products) lists: ground truth or submission."""
    return scan_csv(spark, path, schema.ORDER_LISTS)

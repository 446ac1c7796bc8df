"""Processed datasets and result files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from .. import schema
from .csv_tables import CSV_OPTIONS, scan_csv


def _parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save_dataset(path: str, train: DataFrame | None, test: DataFrame | None) -> None:
    """Keep the processed train and test matrices; a missing one is skipped."""
    for name, frame in (("train", train), ("test", test)):
        if frame is not None:
            frame.write.mode("overwrite").parquet(f"{path}/{name}_dataset")


def load_dataset(
    spark: SparkSession, path: str, types: T.StructType = schema.MATRIX_TYPES
) -> tuple[DataFrame, DataFrame]:
    """The processed matrices, or the raw CSV, with the columns ``types``, of a
    set not yet processed."""

    def one(name: str) -> DataFrame:
        stored = _parquet_or_none(spark, f"{path}/{name}_dataset")
        return stored if stored is not None else scan_csv(spark, f"{path}/{name}.csv", types)

    return one("train"), one("test")


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table stored at ``path``; built and stored there on first use."""
    stored = _parquet_or_none(spark, path)
    if stored is None:
        build().write.mode("errorifexists").parquet(path)
        stored = spark.read.parquet(path)
    return stored


def submission_name(score: float, at: datetime) -> str:
    """File name of a submission made at a given time with a given CV score."""
    return f"submission_{at:%Y_%m_%d_%H_%M_%S}_{score}.csv"


def write_submission(lists: DataFrame, path: str) -> None:
    """(order_id, products) as CSV, globally sorted by order. Range partitions
    are written in parallel: the part files in name order are the sorted file."""
    lists.select("order_id", "products").orderBy("order_id").write.mode(
        "overwrite"
    ).options(**{k: CSV_OPTIONS[k] for k in ("header", "quote", "escape")}).csv(path)


def write_scored_submission(lists: DataFrame, folder: str, score: float, at: datetime | None = None) -> str:
    """:func:`write_submission` under the name that tells its CV score and the time
    it was made, by default now; returns the path."""
    path = f"{folder.rstrip('/')}/{submission_name(score, at or datetime.now())}"
    write_submission(lists, path)
    return path


def write_ground_truth(lists: DataFrame, path: str) -> None:
    write_submission(lists, path)


def sample_rows(df: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """``n`` rows drawn at random, or every row in random order when ``n`` is
    omitted. The draw is by the MD5 sum of the row's values, so it survives
    recomputation and can be repeated elsewhere."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in df.columns])
    shuffled = df.orderBy(F.md5(text.cast("binary")))
    return shuffled if n is None else shuffled.limit(n)

"""Basket tables and shared intermediates of one dataset in one session."""

from __future__ import annotations

from functools import cached_property
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import decode, learn, matrix_ops, segments
from .plans import features
from .sources.fixtures import BasketTables
from .sources.store import Ledger, Store


class Workspace:
    trees: int | None = None  # of the base learners' ensembles; None: their own settings

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.store = Store(spark)
        self.ledger = Ledger(spark)  # of model fits, which several queries share
        self.tables = BasketTables(spark, sf_dir, self.store)

    @cached_property
    def matrix(self) -> DataFrame:
        """The feature matrix, built and stored on first use. One folder per
        eval set, so the train/test split is a choice of folders."""
        built = features.feature_matrix(self.spark, self.tables, self.store)
        return self.store.put_partitioned(built, "matrix", ["eval_set"])

    @property
    def train(self) -> DataFrame:
        return features.split_matrix(self.matrix)[0]

    @property
    def test(self) -> DataFrame:
        return features.split_matrix(self.matrix)[1]

    @property
    def scored(self) -> DataFrame:
        """The matrix with a deterministic score in place of a model's."""
        return self.matrix.withColumn("score", F.col("_up_order_rate"))

    @property
    def scored_train(self) -> DataFrame:
        return self.train.withColumn("score", F.col("_up_order_rate"))

    @property
    def truth(self) -> DataFrame:
        return decode.ground_truth(self.tables["train"])

    @cached_property
    def vectors(self) -> DataFrame:
        filled = matrix_ops.label_fill(self.train)
        return self.store.put(learn.vectorize(filled), "train_vectors")

    @cached_property
    def booster(self):
        """The boosted trees of the submission, fitted on the whole train matrix."""
        return learn.gbt_train(self.vectors, ledger=self.ledger)

    @cached_property
    def test_vectors(self) -> DataFrame:
        return self.store.put(learn.vectorize(self.test).drop("label"), "test_vectors")

    @cached_property
    def ridge_unit(self) -> float:
        return learn.ridge_unit(self.vectors)

    @cached_property
    def aisle_counts(self) -> DataFrame:
        return self.store.put(segments.user_aisle_counts(self.tables), "aisle_counts")

    @cached_property
    def components(self) -> DataFrame:
        return self.store.put(segments.user_pca(self.aisle_counts, store=self.store)[0], "components")

    @cached_property
    def clusters(self) -> DataFrame:
        points = segments.pca_pair(self.components)
        return self.store.put(segments.user_clusters(points)[0], "clusters")

    @property
    def fixed_segments(self) -> DataFrame:
        """Users in four segments by id, for results that can be recomputed."""
        return self.aisle_counts.select("user_id").distinct().select(
            "user_id", F.pmod("user_id", F.lit(4)).cast("int").alias("segment")
        )


_open: dict[tuple[str, str], Workspace] = {}
_opening = Lock()


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _opening:
        if key not in _open:
            _open[key] = Workspace(spark, sf_dir)
        return _open[key]

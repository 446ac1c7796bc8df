"""Boosted models after each of their rounds, from one pass over the rows.

The sum of the first r trees is the model of r rounds, as boosting draws the
same trees whatever the number that follows. A model's trees are small tables
of nodes; a batch of rows descends them with array operations, and the
running sums over the trees are the margins after each round.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import Store

FEATURES, LABEL = "features", "label"


@dataclass
class Trees:
    """Nodes of all trees, one after the other; a leaf's children are itself."""

    roots: np.ndarray
    weights: np.ndarray
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    # of a split on categories: where its row of ``goes_left`` begins, else -1
    codes: np.ndarray
    goes_left: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the sum of the first trees of each row."""
        out = np.empty((len(x), len(self.roots)))
        rows = np.arange(len(x))
        categorical = bool((self.codes >= 0).any())
        for tree, root in enumerate(self.roots):
            at = np.full(len(x), root)
            for _ in range(self.depth):
                value = x[rows, self.feature[at]]
                left = value <= self.threshold[at]
                if categorical:
                    coded = np.flatnonzero(self.codes[at] >= 0)
                    left[coded] = self.goes_left[self.codes[at[coded]] + value[coded].astype(np.int64)]
                at = np.where(left, self.left[at], self.right[at])
            out[:, tree] = self.weights[tree] * self.value[at]
        return out.cumsum(axis=1)


def read_trees(model: Model) -> Trees:
    """The nodes of a fitted ensemble, from its saved form."""
    spark = _session()
    with Store(spark) as store:
        path = store.path("ensemble")
        model.write().save(path)
        split = F.col("nodeData.split")
        nodes = spark.read.parquet(f"{path}/data").select(
            "treeID",
            "nodeData.id",
            "nodeData.prediction",
            "nodeData.leftChild",
            "nodeData.rightChild",
            split["featureIndex"].alias("feature"),
            split["leftCategoriesOrThreshold"].alias("cut"),
            split["numCategories"].alias("categories"),
        ).toPandas()  # as many rows as the model has nodes
    nodes = nodes.sort_values(["treeID", "id"], ignore_index=True)
    size = nodes.groupby("treeID").size().to_numpy()
    roots = np.cumsum(size) - size
    base = np.repeat(roots, size)
    own = np.arange(len(nodes))
    inner = nodes["leftChild"].to_numpy() >= 0
    threshold = np.full(len(nodes), np.inf)
    codes, goes_left, held = np.full(len(nodes), -1), [], 0
    for at in np.flatnonzero(inner):
        cut, categories = nodes["cut"][at], int(nodes["categories"][at])
        if categories < 0:
            threshold[at] = cut[0]
            continue
        codes[at] = held
        held += categories
        row = np.zeros(categories, bool)
        row[np.asarray(cut, np.int64)] = True
        goes_left.append(row)
    left = np.where(inner, base + nodes["leftChild"], own)
    right = np.where(inner, base + nodes["rightChild"], own)
    return Trees(
        roots=roots,
        weights=np.asarray(model.treeWeights),
        depth=max((t.depth for t in model.trees), default=0),
        feature=np.where(inner, nodes["feature"], 0),
        threshold=threshold,
        left=left,
        right=right,
        value=nodes["prediction"].to_numpy(),
        codes=codes,
        goes_left=np.concatenate(goes_left) if goes_left else np.zeros(0, bool),
    )


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.active()


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def staged_scores(model: GBTClassificationModel, vectors: DataFrame, rounds: Sequence[int]) -> DataFrame:
    """``vectors`` without the features, with ``scores``: the probability of 1
    after each of ``rounds``."""
    trees, at = read_trees(model), np.asarray(rounds) - 1
    wanted = int(at.max()) + 1 if len(at) else 0
    if wanted > len(trees.roots):
        raise ValueError(f"the model has {len(trees.roots)} rounds, asked for {wanted}")
    kept = [c for c in vectors.columns if c != FEATURES]
    given = vectors.select(*kept, vector_to_array(FEATURES).alias("_x"))
    schema = T.StructType([*given.drop("_x").schema.fields, T.StructField("scores", T.ArrayType(T.DoubleType()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            margins = trees.margins(_matrix(rows["_x"]))[:, at]
            scores = pa.array(list(1 / (1 + np.exp(-2 * margins))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), scores], names=[*kept, "scores"])

    return given.mapInArrow(score, schema)


def round_losses(model: GBTClassificationModel, vectors: DataFrame) -> DataFrame:
    """(round, loss, n): the summed logistic loss after each round and the
    number of rows, over all rows of ``vectors``."""
    trees = read_trees(model)
    given = vectors.select(vector_to_array(FEATURES).alias("_x"), F.col(LABEL).cast("double").alias("_y"))

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(trees.roots)), 0
        for rows in batches:
            if not rows.num_rows:
                continue
            sign = 2 * rows["_y"].to_numpy()[:, None] - 1
            total += (2 * np.logaddexp(0, -2 * sign * trees.margins(_matrix(rows["_x"])))).sum(axis=0)
            n += rows.num_rows
        rounds = np.arange(1, len(total) + 1, dtype=np.int32)
        yield pa.RecordBatch.from_pydict({"round": rounds, "loss": total, "n": np.full(len(total), n)})

    # one row per round and partition
    parts = given.mapInArrow(losses, "round int, loss double, n long")
    return parts.groupBy("round").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n"))


def leading_trees(model: GBTClassificationModel, rounds: int, learner: Estimator) -> GBTClassificationModel:
    """The model after its first ``rounds`` rounds. ``learner`` fitted it."""
    trees = list(model._java_obj.trees())[:rounds]
    jvm = _session()._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    held = _session().sparkContext._gateway.new_array(kind, len(trees))
    weights = _session().sparkContext._gateway.new_array(jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, model.treeWeights)):
        held[i], weights[i] = tree, float(weight)
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, held, weights)
    return learner._copyValues(GBTClassificationModel(cut))

"""Ordinal cumulative-link regression on sparse text features.

    P(grade <= k) = logistic(threshold[k] - w . x)

One weight vector is shared by all thresholds; the thresholds are ordered by
construction. A text's features are hashed to ``DIMENSIONS`` numbers. Training
takes at most ``sample`` labelled rows, those with the smallest hash of their
id, so that the choice does not depend on the layout of the table; the bound is
a parameter. The sample's features are counted by grade, the ``features`` with
the strongest association with the grade are kept, and the likelihood with a
quadratic penalty is climbed by Fisher scoring, each step one Spark job over the
stored sample that returns one gradient and one information per partition.

Grades are whole numbers from 0; rows without a grade or a text do not train. A
table without labels, or with one grade, gives a model without weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import Store
from .text import blocks, bound_batches, output

DIMENSIONS = 1 << 18
ROWS_AT_ONCE = 2_048  # that a task spreads out densely
LONGEST_STEP = 3.0
EXTRACT_BYTES = 1 << 20  # of text whose features, all of them, are held at once
#: rows of a column of texts -> (row, feature, value), each pair once
Featurizer = Callable[[pa.ChunkedArray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000
    features: int = 512
    least_rows: int = 5  # that a feature occurs in
    least_association: float = 25.0  # chi-squared
    steps: int = 12
    close: float = 1e-3  # the longest step that ends the climb
    penalty: float = 1e-4
    false_alarm: float = 5.0  # weight of a wrongly rejected row against a caught one
    partitions: int = 8


@dataclass
class Model:
    thresholds: np.ndarray
    features: np.ndarray  # hashed numbers, ascending
    weights: np.ndarray
    limits: np.ndarray  # of P(grade > k), one for each threshold, see cuts()

    def dense(self) -> np.ndarray:
        table = np.zeros(DIMENSIONS)
        table[self.features] = self.weights
        return table

    def tails(self, margins: np.ndarray) -> np.ndarray:
        """P(grade > k) for each margin and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - margins[:, None], -60, 60)))


def training_rows(
    docs: DataFrame, labels: DataFrame, featurize: Featurizer, settings: Settings, store: Store
) -> DataFrame:
    """(grade, features array<int>, values array<float>) of the sampled rows.
    ``labels`` has doc_id and grade."""
    sample = (
        labels.select("doc_id", F.col("grade").cast("int").alias("grade"))
        .filter("doc_id is not null and grade is not null")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade")
        .limit(settings.sample)
    )
    sample = store.put(sample, "sampled_labels")
    result = pa.schema(
        [("id", pa.int64()), ("grade", pa.int32()), ("features", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text", EXTRACT_BYTES):
            row, feature, value = featurize(rows["text"])
            order = np.argsort(row, kind="stable")
            edges = np.searchsorted(row[order], np.arange(rows.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    rows["id"].combine_chunks(),
                    rows["grade"].combine_chunks(),
                    pa.ListArray.from_arrays(edges, pa.array(feature[order].astype(np.int32))),
                    pa.ListArray.from_arrays(edges, pa.array(value[order].astype(np.float32))),
                ],
                schema=result,
            )

    chosen = (
        docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
        .filter("text is not null")
        .join(sample.withColumnRenamed("doc_id", "id"), "id")
        .select("id", "grade", "text")
    )
    extracted = chosen.mapInArrow(extract, "id long, grade int, features array<int>, values array<float>")
    # Copies of a text would lend its chance words the weight of evidence.
    once = extracted.groupBy("grade", "features", "values").agg(F.min("id").alias("id"))
    return store.put(once, "sample")


def fit(rows: DataFrame, settings: Settings, store: Store) -> Model:
    sizes = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}  # one row a grade
    top = max(sizes, default=0)
    total = sum(sizes.values())
    if len(sizes) < 2:
        flat = np.zeros(max(top, 1))
        return Model(flat, np.zeros(0, np.int64), np.zeros(0), flat + 1.0)
    above = [sum(n for g, n in sizes.items() if g > k) for k in range(top)]
    share = np.clip(np.array(above) / total, 1e-6, 1 - 1e-6)
    thresholds = np.log1p(-share) - np.log(share)

    # Association of each feature with "graded above k", the strongest over k.
    seen = rows.select("grade", F.explode("features").alias("feature")).groupBy("feature", "grade").count()
    sums = [F.sum(F.when(F.col("grade") > k, F.col("count")).otherwise(0)).alias(f"above_{k}") for k in range(top)]
    tested = seen.groupBy("feature").agg(F.sum("count").alias("n"), *sums).filter(F.col("n") >= settings.least_rows)
    n = F.col("n")
    chi = [
        F.pow(F.col(f"above_{k}") * total - n * above[k], 2)
        * total
        / F.lit(float(max(above[k] * (total - above[k]), 1)))
        / (n * F.greatest(total - n, F.lit(1)))
        for k in range(top)
    ]
    strength = F.greatest(*chi) if len(chi) > 1 else chi[0]
    strongest = (
        tested.select("feature", strength.alias("strength"))
        .filter(F.col("strength") >= settings.least_association)
        .orderBy(F.desc("strength"), "feature")
        .limit(settings.features)
    )
    features = np.array(sorted(r["feature"] for r in strongest.collect()), np.int64)  # at most settings.features

    result = pa.schema([("grade", pa.int32()), ("at", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["features"].flatten().to_numpy()
            value = batch["values"].flatten().to_numpy()
            edges = np.append(0, np.cumsum(batch["features"].value_lengths().to_numpy())).astype(np.int64)
            at = np.searchsorted(features, flat)
            keep = (at < len(features)) & (features[np.minimum(at, len(features) - 1)] == flat) if len(features) else np.zeros(len(flat), bool)
            kept = np.append(0, np.cumsum(keep))[edges].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["grade"],
                    pa.ListArray.from_arrays(kept, pa.array(at[keep].astype(np.int32))),
                    pa.ListArray.from_arrays(kept, pa.array(value[keep])),
                ],
                schema=result,
            )

    narrowed = store.put(
        rows.repartition(settings.partitions, "id").sortWithinPartitions("id").mapInArrow(narrow, "grade int, at array<int>, values array<float>"),
        "narrowed_sample",
    )
    return _climb(narrowed, thresholds, features, total, settings)


def _climb(rows: DataFrame, thresholds: np.ndarray, features: np.ndarray, total: int, settings: Settings) -> Model:
    """Fisher scoring: each step is one job, in which every partition adds up
    its gradient and information."""
    width = len(features)
    size = width + len(thresholds)
    state = np.concatenate([np.zeros(width), thresholds])
    penalty = np.zeros(size)
    penalty[:width] = settings.penalty * total

    for _ in range(settings.steps):
        weights, bounds = state[:width].copy(), state[width:].copy()

        def terms(
            batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights, bounds: np.ndarray = bounds
        ) -> Iterator[pa.RecordBatch]:
            gradient, information = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                    slope, curve = slope_and_information(batch.slice(start, ROWS_AT_ONCE), weights, bounds)
                    gradient += slope
                    information += curve
            packed = np.concatenate([gradient, information[np.triu_indices(size)]])
            yield pa.record_batch([pa.array([packed.tobytes()], pa.binary())], ["terms"])

        parts = rows.mapInArrow(terms, "terms binary").collect()  # one vector a partition
        summed = sum((np.frombuffer(r["terms"]) for r in parts), np.zeros(size + size * (size + 1) // 2))
        gradient = summed[:size] + penalty * state
        information = np.zeros((size, size))
        information[np.triu_indices(size)] = summed[size:]
        information += np.triu(information, 1).T + np.diag(penalty + 1e-9)
        step = np.linalg.solve(information, gradient)
        step *= min(1.0, LONGEST_STEP / max(np.abs(step).max(), 1e-12))
        while (np.diff(state[width:] - step[width:]) <= 0).any():  # thresholds keep their order
            step /= 2
        state = state - step
        if np.abs(step).max() < settings.close:
            break
    return Model(state[width:], features, state[:width], cuts(*_margins(rows, state[:width]), state[width:], settings))


def _margins(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grades and margins of the sample, at most settings.sample of them."""

    def margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = np.repeat(np.arange(batch.num_rows), batch["at"].value_lengths().to_numpy())
            value = weights[batch["at"].flatten().to_numpy()] * batch["values"].flatten().to_numpy()
            yield pa.record_batch([batch["grade"], pa.array(_summed(row, value, batch.num_rows))], ["grade", "margin"])

    got = rows.mapInArrow(margin, "grade int, margin double").toArrow()
    return got["grade"].to_numpy(), got["margin"].to_numpy()


def _summed(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, value, minlength=rows).astype(np.float64)  # whole numbers if there are none


def cuts(grade: np.ndarray, margin: np.ndarray, bounds: np.ndarray, settings: Settings) -> np.ndarray:
    """For each threshold the probability that best tells the sample's rows
    above it from the others: the share caught less ``false_alarm`` times the
    share of the others that go with them, halfway between two rows."""
    order = np.argsort(-margin)
    steps = np.append(margin[order], margin.min(initial=0) - 1)
    limits = []
    for k, bound in enumerate(bounds):
        above = grade[order] > k
        caught = np.append(0, np.cumsum(above)) / max(above.sum(), 1)
        wrong = np.append(0, np.cumsum(~above)) / max((~above).sum(), 1)
        ends = np.append(True, np.diff(margin[order]) != 0)  # cut between different margins only
        ends = np.append(ends, True)
        gain = np.where(ends, caught - settings.false_alarm * wrong, -np.inf)
        best = int(np.argmax(gain))
        cut = steps[0] + 1 if best == 0 else (steps[best - 1] + steps[best]) / 2
        limits.append(1 / (1 + np.exp(bound - cut)))
    return np.array(limits)


def slope_and_information(batch: pa.RecordBatch, weights: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log-likelihood: its gradient by weights and thresholds,
    and the expected information."""
    grade = batch["grade"].to_numpy()
    n, levels = len(grade), len(bounds)
    x = np.zeros((n, len(weights)))
    lengths = batch["at"].value_lengths().to_numpy()
    x[np.repeat(np.arange(n), lengths), batch["at"].flatten().to_numpy()] = batch["values"].flatten().to_numpy()
    below = 1 / (1 + np.exp(-np.clip(bounds[None, :] - (x @ weights)[:, None], -50, 50)))
    # P(grade <= k) and its derivative by the threshold, with 0 and 1 at the ends
    dense = np.pad(below * (1 - below), ((0, 0), (1, 1)))
    chance = np.maximum(np.diff(np.pad(below, ((0, 0), (1, 1)), constant_values=((0, 0), (0, 1)))), 1e-12)
    by_margin = dense[:, :-1] - dense[:, 1:]  # of each grade's chance
    by_bound = np.zeros((n, levels + 1, levels))
    for k in range(levels):
        by_bound[:, k, k] = dense[:, k + 1]
        by_bound[:, k + 1, k] = -dense[:, k + 1]
    row = np.arange(n)
    own = 1 / chance[row, grade]
    slope = np.concatenate([-(x.T @ (by_margin[row, grade] * own)), -(by_bound[row, grade] * own[:, None]).sum(axis=0)])
    margin_margin = (by_margin**2 / chance).sum(axis=1)
    margin_bound = ((by_margin / chance)[:, :, None] * by_bound).sum(axis=1)
    bound_bound = np.einsum("nkj,nkl,nk->jl", by_bound, by_bound, 1 / chance)
    cross = x.T @ margin_bound
    return slope, np.block([[(x * margin_margin[:, None]).T @ x, cross], [cross.T, bound_bound]])


def train(docs: DataFrame, labels: DataFrame, featurize: Featurizer, settings: Settings = Settings()) -> Model:
    bound_batches(docs.sparkSession)
    store = Store(docs.sparkSession)
    return fit(training_rows(docs, labels, featurize, settings, store), settings, store)


def score(
    docs: DataFrame,
    model: Model,
    featurize: Featurizer,
    expected_col: str = "expected_grade",
    tail_col: str = "tail_probability",
    threshold: int = 0,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the expected grade and P(grade > threshold) of each row's
    whole text as further columns. Null counts as empty."""
    bound_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(expected_col, T.DoubleType()), T.StructField(tail_col, T.DoubleType())]
    )

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.dense()
        for batch in batches:
            row, feature, value = featurize(pa.chunked_array([batch.column(at)]), table != 0)
            margins = _summed(row, table[feature] * value, batch.num_rows)
            tails = model.tails(margins)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, threshold])],
                [*batch.schema.names, expected_col, tail_col],
            )

    return docs.mapInArrow(grade, schema)

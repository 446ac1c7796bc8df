"""Linear models from sums of products: one pass for all folds and penalties.

Least squares with a penalty needs of its rows only the number, the means, and
the products of every two columns, summed. One pass adds these up per fold;
a fit on all folds but one is the total less that fold's sums, and the held-out
error is a function of the fold's own. However many penalties are tried, no row is
read again. The sums have the size of the squared number of columns.

Columns are shifted by their overall mean before they are multiplied, so that sums
of large values of little spread keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES, LABEL = "features", "label"


@dataclass
class Moments:
    """``total[0, 0]`` rows; sums of products of (1, columns, label), the columns
    and the label less ``shift``."""

    total: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.total + other.total, self.shift)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.total - other.total, self.shift)

    @property
    def rows(self) -> float:
        return self.total[0, 0]

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Products of the columns and with the label about their means, and
        the means of (columns, label) less ``shift``."""
        mean = self.total[0, 1:] / self.rows
        about = self.total[1:, 1:] - self.rows * np.outer(mean, mean)
        return about[:-1, :-1], about[:-1, -1], mean

    def squared_error(self, weights: np.ndarray, intercept: float) -> float:
        """Sum over the rows of the squared error of a linear model."""
        constant = intercept + self.shift[:-1] @ weights - self.shift[-1]
        w = np.concatenate([[constant], weights, [-1.0]])
        return float(w @ self.total @ w)

    def spread(self) -> float:
        """Sum of the label's squared distance from its mean."""
        return float(self.total[-1, -1] - self.total[0, -1] ** 2 / self.rows)

    def _model(self, weights: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, float]:
        return weights, float(mean[-1] + self.shift[-1] - (mean[:-1] + self.shift[:-1]) @ weights)

    def ridge(self, penalty: float) -> tuple[np.ndarray, float]:
        """(weights, intercept) with ``penalty`` times the squared weights on
        the summed squared error."""
        products, with_label, mean = self.centred()
        system = products + penalty * np.eye(len(products))
        return self._model(np.linalg.lstsq(system, with_label, rcond=None)[0], mean)

    def lasso(self, penalty: float, tolerance: float = 1e-12, most: int = 100_000) -> tuple[np.ndarray, float]:
        """(weights, intercept) with ``penalty`` times the absolute weights on
        half the mean squared error, by coordinate descent."""
        products, with_label, mean = self.centred()
        products, with_label = products / self.rows, with_label / self.rows
        weights, scale = np.zeros(len(with_label)), np.diag(products)
        live = np.flatnonzero(scale > 1e-14 * max(scale.max(initial=0.0), 1e-300))
        for _ in range(most):
            moved = 0.0
            for j in live:
                alone = with_label[j] - products[j] @ weights + scale[j] * weights[j]
                new = np.sign(alone) * max(abs(alone) - penalty, 0.0) / scale[j]
                moved = max(moved, abs(new - weights[j]) * np.sqrt(scale[j]))
                weights[j] = new
            if moved <= tolerance:
                return self._model(weights, mean)
        raise RuntimeError(f"coordinate descent did not settle in {most} rounds")


def product_sums(vectors: DataFrame, shift: Sequence[float] | None = None, fold: str = "fold") -> DataFrame:
    """(fold, i, j, total): sums of products of the columns 0 (which is 1), 1 to d
    (the features) and d + 1 (the label), for i <= j; less ``shift`` for all but
    the first. Rows of every fold are added up where they are read."""
    given = vectors.select(
        F.col(fold).cast("int").alias("fold"),
        vector_to_array(FEATURES).alias("x"),
        F.col(LABEL).cast("double").alias("y"),
    )
    away = None if shift is None else np.asarray(shift, float)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for rows in batches:
            if not rows.num_rows:
                continue
            x = rows["x"].flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            z = np.column_stack([x, rows["y"].to_numpy()])
            z = np.column_stack([np.ones(len(z)), z if away is None else z - away])
            folds = rows["fold"].to_numpy()
            for number in np.unique(folds).tolist():
                part = z[folds == number]
                held[number] = held.get(number, 0.0) + part.T @ part
        for number, total in held.items():
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict(
                {"fold": np.full(len(i), number, np.int32), "i": i.astype(np.int32), "j": j.astype(np.int32), "total": total[i, j]}
            )

    # one row per partition, fold and pair of columns
    parts = given.mapInArrow(add, "fold int, i int, j int, total double")
    return parts.groupBy("fold", "i", "j").agg(F.sum("total").alias("total"))


def fold_moments(vectors: DataFrame, fold: str = "fold") -> dict[int, Moments]:
    """The sums of each fold."""
    row = vectors.agg(Summarizer.mean(F.col(FEATURES)).alias("x"), F.avg(LABEL).alias("y")).first()
    if row["x"] is None:
        return {}
    shift = np.append(row["x"].toArray(), row["y"])
    size = len(shift) + 1
    found: dict[int, Moments] = {}
    for r in product_sums(vectors, shift.tolist(), fold).collect():  # folds times squared columns
        into = found.setdefault(r["fold"], Moments(np.zeros((size, size)), shift)).total
        into[r["i"], r["j"]] = into[r["j"], r["i"]] = r["total"]
    return found


Model = tuple[np.ndarray, float]


def held_out_models(moments: Mapping[int, Moments], kind: str, penalties: Sequence[float]) -> dict[int, list[Model]]:
    """For each fold, the models of all ``penalties`` fitted to the other folds."""
    whole = None
    for part in moments.values():
        whole = part if whole is None else whole + part
    return {fold: [getattr(whole - part, kind)(p) for p in penalties] for fold, part in moments.items()}


def scores_by_penalty(vectors: DataFrame, models: Mapping[int, Sequence[Model]], fold: str = "fold") -> DataFrame:
    """``vectors`` without the features, with ``scores``: each row's predictions
    by the models of its fold, one for each penalty."""
    kept = [c for c in vectors.columns if c != FEATURES]
    given = vectors.select(*kept, vector_to_array(FEATURES).alias("_x"))
    weights = {f: np.column_stack([w for w, _ in listed]) for f, listed in models.items()}
    bias = {f: np.array([b for _, b in listed]) for f, listed in models.items()}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            x = rows["_x"].flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            folds = rows[fold].to_numpy()
            out = np.empty((len(x), len(next(iter(bias.values())))))
            for number in np.unique(folds).tolist():
                mine = folds == number
                out[mine] = x[mine] @ weights[number] + bias[number]
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), pa.array(list(out), pa.list_(pa.float64()))], names=[*kept, "scores"])

    schema = given.drop("_x").withColumn("scores", F.array().cast("array<double>")).schema
    return given.mapInArrow(score, schema)

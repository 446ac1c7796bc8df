"""Toxicity by ordinal regression on words and word beginnings.

The grades are severities from 0. The label table of this project knows two,
so its model has one threshold; the regression takes any number.

A null or empty text has no features and is scored like any text without known
words. Rows that repeat are scored alike; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordinal
from .features import vocabulary

SETTINGS = ordinal.Settings()


def severities(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.col("toxic").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, settings: ordinal.Settings = SETTINGS) -> ordinal.Model:
    return ordinal.train(docs, severities(labels), vocabulary, settings)


def score(docs: DataFrame, model: ordinal.Model, severity_col: str = "expected_severity", tail_col: str = "p_toxic") -> DataFrame:
    return ordinal.score(docs, model, vocabulary, severity_col, tail_col)


def clean(docs: DataFrame, labels: DataFrame, reject: float | None = None) -> DataFrame:
    """``docs`` without the rows whose probability of being toxic is at least
    ``reject``, by default the limit that tells the training rows apart."""
    severity, tail = _free(docs, "severity"), _free(docs, "tail")
    model = train(docs, labels)
    limit = float(model.limits[0]) if reject is None else reject
    scored = score(docs, model, severity, tail)
    return scored.filter(F.col(tail) < limit).select(*docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text")
    model = train(rows, labels)
    return score(rows, model).select(
        "doc_id", "expected_severity", "p_toxic", (F.col("p_toxic") >= float(model.limits[0])).alias("toxic")
    )

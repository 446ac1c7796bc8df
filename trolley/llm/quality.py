"""Quality by ordinal regression on words and the shapes of tokens.

Grades run from 0, the worst. The label table gives three: low quality; good
but toxic; good. The expected grade ranks documents, the probability of a grade
above 0 selects them.

A null or empty text has no features and is scored like any text without known
ones. Rows that repeat are scored alike; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordinal
from .features import style

SETTINGS = ordinal.Settings()
SELECT = 0.5


def grades(labels: DataFrame) -> DataFrame:
    quality, toxic = F.col("quality"), F.coalesce("toxic", F.lit(0))
    return labels.select(
        "doc_id", F.when(quality == 0, 0).when(quality == 1, F.when(toxic == 1, 1).otherwise(2)).alias("grade")
    )


def train(docs: DataFrame, labels: DataFrame, settings: ordinal.Settings = SETTINGS) -> ordinal.Model:
    return ordinal.train(docs, grades(labels), style, settings)


def score(docs: DataFrame, model: ordinal.Model) -> DataFrame:
    return ordinal.score(docs, model, style, "expected_grade", "p_good")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text")
    return score(rows, train(rows, labels)).select(
        "doc_id", "expected_grade", "p_good", (F.col("p_good") >= SELECT).alias("selected")
    )

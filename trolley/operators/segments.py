"""Customer segmentation by aisle profile."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import Store
from .encode import label_codes
from .joins import Tables
from .ranking import share

def user_aisle_counts(tables: Tables, lines: DataFrame | None = None) -> DataFrame:
    """(user_id, aisle, n) for every aisle a user bought from, over all prior
    lines or the given ones.

    Lines are counted under one aisle id per name, so that the shuffle carries
    numbers; the names are joined to the counts. Each dimension is joined to
    the lines by itself: Catalyst knows the size of a scan, while it takes the
    size of a join to be the product of its sides and would not broadcast it.
    """
    same_name = F.min("aisle_id").over(Window.partitionBy("aisle"))
    aisles = tables["aisles"].withColumn("_aisle", same_name)
    lines = tables["prior"] if lines is None else lines
    return (
        lines.join(tables["orders"].select("order_id", "user_id"), "order_id")
        .join(tables["products"].select("product_id", "aisle_id"), "product_id")
        .join(aisles.select("aisle_id", "_aisle"), "aisle_id")
        .groupBy("user_id", "_aisle")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(aisles.filter(F.col("aisle_id") == F.col("_aisle")), "_aisle")
        .select("user_id", "aisle", "n")
    )


def aisle_codes(counts: DataFrame, store: Store | None = None) -> DataFrame:
    """(aisle, code) of the aisles in ``counts``, 0..k-1 in order of their names."""
    store = store or Store(counts.sparkSession)
    return store.put(label_codes(counts, "aisle", store), "aisle_codes")


def sparse_table(counts: DataFrame, codes: DataFrame) -> DataFrame:
    """(user_id, cells): the contingency table by row, ``cells`` the (code, n) of
    the aisles that a user bought from, in order of their code. A row is as long as
    its user has aisles; the zeros are not written down."""
    cells = F.array_sort(F.collect_list(F.struct("code", "n")))
    return counts.join(codes, "aisle").groupBy("user_id").agg(cells.alias("cells"))


def user_aisle_crosstab(counts: DataFrame, store: Store | None = None) -> DataFrame:
    """The contingency table as (user_id, aisle, n) rows, zeros included."""
    codes = aisle_codes(counts, store)
    size = codes.agg(F.count("*").cast("int")).scalar()
    rows = sparse_table(counts, codes)
    known = F.map_from_entries("cells").alias("known")
    grid = rows.select("user_id", known, F.explode(F.sequence(F.lit(0), size - 1)).alias("code"))
    cells = grid.select("user_id", "code", F.coalesce(F.col("known")[F.col("code")], F.lit(0)).alias("n"))
    return cells.join(codes, "code").select("user_id", "aisle", "n")


def co_occurrence(rows: DataFrame) -> DataFrame:
    """(i, j, total): for every two aisles with common users, i <= j, the sum
    over the users of the product of their counts. Products are added up where a
    user's row is read; what is shuffled has the size of the squared number of aisles."""
    left = rows.select("cells", F.explode("cells").alias("a"))
    right = left.select("a", F.explode(F.filter("cells", lambda c: c["code"] >= F.col("a.code"))).alias("b"))
    product = F.col("a.n").cast("double") * F.col("b.n")
    return right.groupBy(F.col("a.code").alias("i"), F.col("b.code").alias("j")).agg(F.sum(product).alias("total"))


@dataclass
class Components:
    """``pc``: loadings, one row per aisle code, one column per component.
    ``explainedVariance``: each component's share of the total variance."""

    pc: np.ndarray
    explainedVariance: np.ndarray
    means: np.ndarray
    codes: DataFrame


def leading_vectors(
    matrix: np.ndarray, k: int, spare: int = 8, tolerance: float = 1e-11, most: int = 100_000
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix without negative ones,
    and their vectors, by block power iteration: a block of ``k`` + ``spare`` vectors is
    multiplied and made orthonormal until the wanted ones stay in their place."""
    width = min(k + spare, len(matrix))
    block = np.linalg.qr(np.random.default_rng(0).normal(size=(len(matrix), width)))[0]
    scale = max(float(np.trace(matrix)), 1e-300)
    for _ in range(most):
        image = matrix @ block
        values, turn = np.linalg.eigh(block.T @ image)  # of the block's few vectors
        order = np.argsort(values)[::-1]
        values, vectors = values[order], block @ turn[:, order]
        off = image @ turn[:, order] - vectors * values
        if np.linalg.norm(off[:, :k], axis=0).max(initial=0.0) <= tolerance * scale:
            return values[:k], vectors[:, :k]
        block = np.linalg.qr(image)[0]
    raise RuntimeError(f"the leading components did not settle in {most} rounds")


def user_pca(counts: DataFrame, k: int = 6, store: Store | None = None) -> tuple[DataFrame, Components]:
    """(user_id, pc): the first ``k`` principal components of the users' centred
    counts per aisle. Components are defined up to sign; each is turned so that its
    loading of greatest magnitude is positive.

    ``counts`` is (user_id, aisle, n). No dense table is made: the covariance comes
    from the aisles' co-occurrence, whose sums alone reach the driver (the
    squared number of aisles, a catalogue's size), and a user's scores are
    sums over the aisles they bought from, less those of the mean."""
    store = store or Store(counts.sparkSession)
    codes = aisle_codes(counts, store)
    rows = store.put(sparse_table(counts, codes), "sparse_rows")
    size, users = codes.count(), rows.count()
    if not users:
        return rows.select("user_id", F.array().cast("array<double>").alias("pc")), Components(
            np.zeros((0, 0)), np.zeros(0), np.zeros(0), codes
        )
    products = np.zeros((size, size))
    for r in co_occurrence(rows).collect():
        products[r["i"], r["j"]] = products[r["j"], r["i"]] = r["total"]
    sums = rows.select(F.explode("cells").alias("c")).groupBy("c.code").agg(F.sum("c.n").alias("total"))
    means = np.zeros(size)
    for r in sums.collect():
        means[r["code"]] = r["total"] / users
    covariance = (products - users * np.outer(means, means)) / max(users - 1, 1)
    values, loadings = leading_vectors(covariance, min(k, size))
    loadings = loadings * np.where(loadings[np.abs(loadings).argmax(axis=0), range(loadings.shape[1])] >= 0, 1.0, -1.0)
    total = np.trace(covariance)
    found = Components(loadings, values / total if total > 0 else values, means, codes)

    weights = counts.sparkSession.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(loadings)], "code int, weights array<double>"
    )
    each = rows.select("user_id", F.explode("cells").alias("c")).select("user_id", "c.code", "c.n").join(weights, "code")
    away = (means @ loadings).tolist()
    parts = [F.sum(F.col("n") * F.col("weights")[i]).alias(f"_{i}") for i in range(len(away))]
    scores = each.groupBy("user_id").agg(*parts)
    return scores.select(
        "user_id", F.array(*[F.col(f"_{i}") - F.lit(a) for i, a in enumerate(away)]).alias("pc")
    ), found


def pca_pair(scores: DataFrame, first: int = 4, second: int = 1) -> DataFrame:
    """The two components that are clustered."""
    return scores.select(
        "user_id", F.col("pc")[first].alias("x"), F.col("pc")[second].alias("y")
    )


def user_clusters(
    points: DataFrame, k: int = 4, seed: int = 42
) -> tuple[DataFrame, KMeansModel]:
    """(user_id, segment): k-means on the component pair."""
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="_point").transform(points)
    model = KMeans(k=k, seed=seed, featuresCol="_point", predictionCol="segment").fit(vectors)
    return model.transform(vectors).select("user_id", "x", "y", "segment"), model


def cluster_profile(counts: DataFrame, segments: DataFrame) -> DataFrame:
    """Mean count per segment and aisle. Users who bought nothing in an aisle
    count as zero: sums are divided by the segment's size."""
    member = segments.select("user_id", "segment")
    sized = (
        counts.select("user_id").distinct().join(member, "user_id")
        .groupBy("segment").agg(F.count(F.lit(1)).alias("_size"))
    )
    summed = (
        counts.join(member, "user_id").groupBy("segment", "aisle")
        .agg(F.sum("n").alias("_total"))
    )
    # every aisle is listed for every segment: one column for each segment
    names = [r["segment"] for r in sized.select("segment").orderBy("segment").collect()]
    if not names:
        return summed.select("segment", "aisle", F.col("_total").cast("double").alias("mean_count"))
    wide = summed.groupBy("aisle").pivot("segment", names).agg(F.sum("_total"))
    wide = wide.toDF("aisle", *[f"_s{i}" for i in range(len(names))])
    kind = summed.schema["segment"].dataType
    cells = wide.select(
        "aisle",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s).cast(kind).alias("segment"), F.col(f"_s{i}").alias("_total"))
                    for i, s in enumerate(names)
                ]
            )
        ).alias("_cell"),
    ).select("aisle", "_cell.*")
    return cells.join(sized, "segment").select(
        "segment",
        "aisle",
        (F.coalesce("_total", F.lit(0)).cast("double") / F.col("_size")).alias("mean_count"),
    )


def cluster_top_aisles(profile: DataFrame, lo: int = 1, hi: int = 10) -> DataFrame:
    """Aisles ranked ``lo`` to ``hi`` by mean count within each segment."""
    ranked = Window.partitionBy("segment").orderBy(F.desc("mean_count"), "aisle")
    return profile.withColumn(
        "position", F.row_number().over(ranked).cast("bigint")
    ).filter(F.col("position").between(lo, hi))


def cluster_share(profile: DataFrame, aisles: DataFrame) -> DataFrame:
    """Mean counts of the chosen aisles as percent of their sum per segment."""
    chosen = profile.join(aisles.select("aisle"), "aisle", "left_semi")
    return share(chosen, "mean_count", within=["segment"]).select(
        "segment", "aisle", (F.col("proportion") * 100).alias("percent")
    )

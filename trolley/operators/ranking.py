"""Positions, shares, top-n and histograms that never sort a whole table or an
unbounded group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import Store

ORDERS_PER_BLOCK = 1 << 15


def position_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    blocks: Mapping[str, Column] | None = None,
    *,
    descending: bool = False,
    position: str = "position",
    size: str | None = None,
    previous: tuple[str, str] | None = None,
) -> DataFrame:
    """1-based position of each row within ``keys`` in ``order_by`` order.

    Without ``blocks`` this is a window over each key: one shuffle, one sort.
    That is right where a key's rows are known to fit one task.

    ``blocks`` are columns that are non-decreasing along ``order_by``. Rows are
    then numbered inside (keys, block), and the row counts of earlier blocks, a
    pre-aggregated table, are added. A key holding a third of all rows is
    thereby spread over its blocks; the largest sort is one block.

    ``size`` names a column for the row count of the whole group.
    ``previous=(source, name)`` adds the preceding row's ``source``, which must
    itself be non-decreasing along ``order_by``.

    Keys must not be NULL and ``order_by`` must be unique within a key.
    """
    direction = F.desc if descending else F.asc
    along = [direction(c) for c in order_by]
    if not blocks:
        group = Window.partitionBy(*keys)
        added = {position: F.row_number().over(group.orderBy(*along)).cast("bigint")}
        if size:
            added[size] = F.count(F.lit(1)).over(group)
        if previous:
            added[previous[1]] = F.lag(previous[0]).over(group.orderBy(*along))
        return df.withColumns(added)

    block = list(blocks)
    cell = [*keys, *block]
    rows = df.withColumns(dict(blocks))

    across = Window.partitionBy(*keys).orderBy(*[direction(b) for b in block])
    counted = [F.count(F.lit(1)).alias("_rows")]
    if previous:
        counted.append(F.max(previous[0]).alias("_last"))
    totals = rows.groupBy(*cell).agg(*counted)
    derived = {"_before": _sum_before("_rows", across)}
    if size:
        derived[size] = F.sum("_rows").over(Window.partitionBy(*keys))
    if previous:
        derived["_carried"] = F.lag("_last").over(across)
    totals = totals.withColumns(derived).drop("_rows", "_last")

    inside = Window.partitionBy(*cell).orderBy(*along)
    local = {"_local": F.row_number().over(inside)}
    if previous:
        local["_lagged"] = F.lag(previous[0]).over(inside)
    placed = rows.withColumns(local).join(totals, cell, "left")

    result = {position: F.col("_before") + F.col("_local")}
    if previous:
        result[previous[1]] = F.when(F.col("_local") == 1, F.col("_carried")).otherwise(
            F.col("_lagged")
        )
    return placed.withColumns(result).drop(
        "_before", "_local", "_carried", "_lagged", *block
    )


def _sum_before(column: str, along) -> Column:
    """Sum over the rows ahead of this one; 0 for the first."""
    ahead = along.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(ahead), F.lit(0))


def range_blocks(df: DataFrame, order_by: Sequence[str], store) -> DataFrame:
    """``df`` with ``_block``, the range partition of each row by ``order_by``.

    Rows distinct in ``order_by`` split into even ranges however they are
    skewed. The numbers are stored, hence the same for every later reader.
    """
    # a stated number of partitions is kept as it is by adaptive execution
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(c) for c in order_by])
    return store.put(ranged.withColumn("_block", F.spark_partition_id()), "ranged")


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probs: Sequence[float],
) -> DataFrame:
    """Exact quantiles per group, interpolated linearly: ``keys``, ``count``,
    ``mean`` and the array ``quantiles``. NULL values are skipped.

    Values are counted per (group, value) first. The counted values are cut into
    even ranges, and the wanted order statistics are found from running totals
    over the ranges: a group of any size is as many tasks as it fills ranges.
    """
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    mean = (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("mean")
    ranged = range_blocks(counted, [*keys, "_v"], Store(df.sparkSession))
    totals = ranged.groupBy(*keys, "_block").agg(F.sum("_n").alias("_in_block"))
    across = Window.partitionBy(*keys).orderBy("_block")
    totals = totals.withColumn("_ahead", _sum_before("_in_block", across))
    inside = Window.partitionBy(*keys, "_block").orderBy("_v")
    from_rank = F.col("_ahead") + F.col("_within")
    runs = (
        ranged.withColumn("_within", _sum_before("_n", inside))
        .join(totals.drop("_in_block"), [*keys, "_block"])
        .select(*keys, "_v", "_n", from_rank.alias("_from"))
    )
    overall = ranged.groupBy(*keys).agg(F.sum("_n").alias("count"), mean)
    ranks = [(F.col("count") - 1) * F.lit(float(p)) for p in probs]
    # the value at 0-based rank r is the run with _from <= r < _from + _n
    reached = runs.join(overall, list(keys))
    found = []
    for i, rank in enumerate(ranks):
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            holds = (F.col("_from") <= at) & (at < F.col("_from") + F.col("_n"))
            found.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{side}{i}"))
    picked = reached.groupBy(*keys, "count", "mean").agg(*found)
    values = [
        F.col(f"_lo{i}")
        + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (rank - F.floor(rank))
        for i, rank in enumerate(ranks)
    ]
    return picked.select(*keys, "count", "mean", F.array(*values).alias("quantiles"))


def top_n(
    df: DataFrame,
    by: str,
    n: int,
    ties: bool = True,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` rows with the largest ``by``.

    With ``ties`` every row equal to the n-th value is kept (rank <= n);
    otherwise exactly ``n`` rows, equal values ordered by ``tiebreak``. Both
    run as a distributed top-k, not as a window over the whole table.
    """
    ranked = df.filter(F.col(by).isNotNull())
    if not ties:
        return ranked.orderBy(F.desc(by), *tiebreak).limit(n)
    cut = ranked.select(by).orderBy(F.desc(by)).limit(n).agg(F.min(by))
    return ranked.filter(F.col(by) >= cut.scalar())


def share(
    df: DataFrame, value: str, within: Sequence[str] = (), name: str = "proportion"
) -> DataFrame:
    """Adds ``value`` as a share of its total, over the table or ``within``
    groups. Meant for counts already aggregated."""
    if within:
        total = F.sum(value).over(Window.partitionBy(*within))
    else:
        total = df.agg(F.sum(value)).scalar()
    return df.withColumn(
        name, F.try_divide(F.col(value).cast("double"), total.cast("double"))
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram between the least and greatest value; the last
    bin is closed. Empty bins are listed with a count of 0."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # one value only: a unit-wide range around it
    spread = F.max("_v") > F.min("_v")
    edges = counts.agg(
        F.when(spread, F.min("_v")).otherwise(F.min("_v") - 0.5).alias("lo"),
        F.when(spread, F.max("_v")).otherwise(F.max("_v") + 0.5).alias("hi"),
    )
    bounds = edges.select(F.struct("lo", "hi")).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    filled = (
        counts.withColumn(
            "bin",
            F.least(
                F.floor((F.col("_v") - lo) / (hi - lo) * bins), F.lit(bins - 1)
            ).cast("int"),
        )
        .groupBy("bin")
        .agg(F.sum("_n").alias("count"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (lo + (hi - lo) * F.col("bin") / bins).alias("lower"),
        (lo + (hi - lo) * (F.col("bin") + 1) / bins).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )

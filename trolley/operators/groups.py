"""Group statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import GroupFunction, Stat, named_stat
from ..sources.store import Store
from .ranking import group_quantiles


def _require_list(**named: object) -> None:
    for name, value in named.items():
        if not isinstance(value, list):
            raise TypeError(f"{name} must be a list, got {type(value).__name__}")


def _aggregate(
    df: DataFrame, keys: list[str], wanted: list[tuple[str, str, Stat]]
) -> DataFrame:
    """``wanted`` is (column, statistic name, statistic). Rows with a missing
    key belong to no group.

    Medians are joined from :func:`group_quantiles`; the built-in median would
    hold all values of a group in one task. So are functions of the caller.
    """
    known = df.dropna(subset=keys)
    apart = [w for w in wanted if w[2] == "median" or isinstance(w[2], GroupFunction)]
    plain = [named_stat(stat)(F.col(column)).alias(new) for column, new, stat in wanted if (column, new, stat) not in apart]
    grouped = known.groupBy(*keys).agg(*plain) if plain else known.select(*keys).distinct()
    for column, new, stat in apart:
        if stat == "median":
            middle = group_quantiles(known, keys, column, [0.5])
            own = middle.select(*keys, F.col("quantiles")[0].alias(new))
        else:
            own = stat.over_groups(known, keys, column, new)
        grouped = grouped.join(own, keys, "left")
    return grouped.select(*keys, *[new for _, new, _ in wanted])


def group_stats_multi(
    df: DataFrame,
    keys: list[str],
    stats: Mapping[str, Mapping[str, Stat]],
    only_new: bool = True,
) -> DataFrame:
    """Several statistics of several columns per group.

    ``stats`` maps column -> {new column: statistic}. With ``only_new=False``
    the statistics are joined back onto every row of ``df``.
    """
    _require_list(keys=keys)
    wanted = [
        (column, new, stat) for column, named in stats.items() for new, stat in named.items()
    ]
    grouped = _aggregate(df, keys, wanted)
    return grouped if only_new else _join_back(df, grouped, keys)


def group_stats_single(
    df: DataFrame,
    keys: list[str],
    target: list[str],
    methods: list[Stat],
    keep_only_stats: bool = True,
) -> DataFrame:
    """Several statistics of one column per group, named
    ``_<keys>_<method>_by_<target>``. All key columns are kept."""
    _require_list(keys=keys, target=target, methods=methods)
    column = "".join(target)
    prefix = "".join(keys)
    wanted = []
    for m in methods:
        label = m if isinstance(m, str) else m.__name__
        wanted.append((column, f"_{prefix}_{label}_by_{column}", m))
    grouped = _aggregate(df, keys, wanted)
    return grouped if keep_only_stats else _join_back(df, grouped, keys)


def _join_back(df: DataFrame, grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    # agg().over(partitionBy(keys)) would hold a whole group in one task. The
    # statistics are stored first: between an aggregate's shuffle and a join on the
    # same key the skew join may split nothing, between a scan's and a join it may.
    return df.join(Store(df.sparkSession).put(grouped, "statistics"), list(keys), "left")


def group_box_stats(
    df: DataFrame,
    by: str,
    column: str,
    target: str = "median",
    ascending: bool = True,
) -> DataFrame:
    """Five-number summary and mean of ``column`` per group, groups sorted by
    ``target`` ('median' or 'mean'). NULL groups and values are skipped."""
    if target not in ("median", "mean"):
        raise ValueError("target must be 'median' or 'mean'")
    cuts = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    found = group_quantiles(df.dropna(subset=[by]), [by], column, list(cuts.values()))
    order = F.asc(target) if ascending else F.desc(target)
    return found.select(
        by,
        "count",
        *[F.col("quantiles")[i].alias(name) for i, name in enumerate(cuts)],
        "mean",
    ).orderBy(order, by)

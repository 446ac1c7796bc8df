"""Aggregates addressable by name."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HELD_NUMBERS = 1 << 20  # of the states a task holds before it hands them on


@dataclass(frozen=True)
class GroupFunction:
    """A caller's own aggregate on arrays, which may stand beside built-in ones.

    ``partial`` turns some of a group's values into a state, a row of numbers;
    ``merge`` turns several states, one a row, into one; ``finish`` turns the last
    state into the result. Values become states batch by batch where they are read,
    and a task merges its states of a group before they are moved. States meet
    sorted by group and are merged as they stream in: no task ever holds a whole
    group, and many small groups are one call into Python. Missing values are left
    out; a group without values gets no result."""

    name: str
    partial: Callable[[np.ndarray], Sequence[float]]
    merge: Callable[[np.ndarray], Sequence[float]]
    finish: Callable[[np.ndarray], float]

    @property
    def __name__(self) -> str:
        return self.name

    def _merged(self, states: Sequence[Sequence[float]]) -> list[float]:
        return list(map(float, self.merge(np.array(states)))) if len(states) > 1 else states[0]

    def over_groups(self, df: DataFrame, keys: Sequence[str], column: str, new: str) -> DataFrame:
        """(keys, new): the result of each group, a double."""
        keys = list(keys)
        given = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_value"))
        kinds = [given.schema[k] for k in keys]
        state = T.StructField("_state", T.ArrayType(T.DoubleType()))

        def table(found: Mapping[tuple, object], last: str) -> pd.DataFrame:
            named = {k: list(part) for k, part in zip(keys, zip(*found))}
            return pd.DataFrame(named | {last: list(found.values())})

        def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict[tuple, list[list[float]]] = {}
            size = 0
            for rows in batches:
                for key, values in _by_group(rows, keys, "_value"):
                    one = list(map(float, self.partial(values)))
                    held.setdefault(key, []).append(one)
                    size += 1 + len(one)
                if size > HELD_NUMBERS:
                    yield table({k: self._merged(v) for k, v in held.items()}, "_state")
                    held, size = {}, 0
            if held:
                yield table({k: self._merged(v) for k, v in held.items()}, "_state")

        def end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            key, last = None, None  # of the group that may go on in the next batch
            for rows in batches:
                done = {}
                for now, states in _by_group(rows, keys, "_state"):
                    if last is not None and now == key:
                        last = self._merged([last, *states])
                        continue
                    if last is not None:
                        done[key] = float(self.finish(np.asarray(last)))
                    key, last = now, self._merged(list(states))
                if done:
                    yield table(done, new)
            if last is not None:
                yield table({key: float(self.finish(np.asarray(last)))}, new)

        states = given.mapInPandas(start, T.StructType([*kinds, state]))
        sorted_states = states.repartition(*keys).sortWithinPartitions(*keys)
        return sorted_states.mapInPandas(end, T.StructType([*kinds, T.StructField(new, T.DoubleType())]))


def _by_group(rows: pd.DataFrame, keys: list[str], column: str) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, values) of the groups of a batch, in order of their first row."""
    rows = rows.dropna(subset=keys)
    if not len(rows):
        return
    number = rows.groupby(keys, sort=False).ngroup().to_numpy()
    order = np.argsort(number, kind="stable")
    begins = np.flatnonzero(np.diff(number[order], prepend=-1))
    heads = rows[keys].iloc[order[begins]]
    parts = np.split(rows[column].to_numpy()[order], begins[1:])
    yield from zip(zip(*[heads[k].tolist() for k in keys]), parts)


Stat = str | Callable[[Column], Column] | GroupFunction

STATS: dict[str, Callable[[Column], Column]] = {
    "count": F.count,
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "median": F.median,
    "nunique": F.count_distinct,
    # space-joined distinct values in ascending order
    "join_set": lambda c: F.concat_ws(
        " ", F.transform(F.sort_array(F.collect_set(c)), lambda v: v.cast("string"))
    ),
}


def named_stat(stat: Stat) -> Callable[[Column], Column]:
    """The aggregate called ``stat``; a callable from a Column to an aggregate
    Column passes through."""
    if callable(stat):
        return stat
    try:
        return STATS[stat]
    except KeyError:
        raise ValueError(f"unknown statistic {stat!r}; known: {sorted(STATS)}") from None

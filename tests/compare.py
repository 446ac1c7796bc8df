"""Runs registered queries beside their SQL.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _key(row):
    return tuple(
        (v is None, "" if v is None else repr(float(v)) if isinstance(v, float) else str(v))
        for v in row
    )


def _rows(table: pa.Table, columns: list[str]) -> list[tuple]:
    return sorted(zip(*[table.column(c).to_pylist() for c in columns]), key=_key)


def difference(actual: pa.Table, expected: pa.Table) -> str | None:
    """What differs between the two results, or None."""
    a, e = sorted(actual.column_names), sorted(expected.column_names)
    if a != e:
        return f"columns {a} != {e}"
    types = {
        c: (str(actual.schema.field(c).type), str(expected.schema.field(c).type))
        for c in a
        if actual.schema.field(c).type != expected.schema.field(c).type
    }
    if types:
        return f"types {types}"
    if actual.num_rows != expected.num_rows:
        return f"{actual.num_rows} rows, expected {expected.num_rows}"
    for x, y in zip(_rows(actual, a), _rows(expected, a)):
        if x != y and not all(
            p == q or (isinstance(p, float) and isinstance(q, float) and math.isnan(p) and math.isnan(q))
            for p, q in zip(x, y)
        ):
            return f"{dict(zip(a, x))} != {dict(zip(a, y))}"
    return None


def check(spark, con, sf_dir: str, name: str) -> tuple[str | None, int, float]:
    import __spark_entry__ as entry

    start = time.time()
    actual = entry.queries()[name](spark, sf_dir).toArrow()
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, actual.num_rows, took
    return difference(actual, con.sql(sql).to_arrow_table()), actual.num_rows, took


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import session

    spark = session()
    folder, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    con = connect(folder)
    unknown = set(entry.oracle_sql()) - set(entry.queries())
    assert not unknown, unknown
    bad = 0
    for name in names:
        try:
            problem, rows, took = check(spark, con, folder, name)
        except Exception as error:  # report and go on to the next query
            problem, rows, took = f"{type(error).__name__}: {str(error)[:600]}", -1, 0
        kind = "sql " if name in entry.oracle_sql() else "rows"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:28s} {rows:8d} {took:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} failed")
    sys.exit(bool(bad))

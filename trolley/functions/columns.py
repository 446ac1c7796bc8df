"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Real-valued division; NULL where the denominator is zero."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(num.cast("double"), den.cast("double"))


def cap(value: Column | str, upper: int) -> Column:
    """``value``, but never above ``upper``; NULL stays NULL."""
    col = F.col(value) if isinstance(value, str) else value
    return F.when(col > upper, F.lit(upper)).otherwise(col)


def flag_above(score: Column | str, limit: float) -> Column:
    col = F.col(score) if isinstance(score, str) else score
    return (col > F.lit(limit)).cast("int")


def name_flag(name: Column | str, pattern: str, yes: str, no: str) -> Column:
    """``yes`` where the name contains ``pattern`` in any letter case."""
    col = F.col(name) if isinstance(name, str) else name
    found = F.lower(col).contains(pattern.lower())
    return F.when(found, F.lit(yes)).when(~found, F.lit(no))

"""Small helpers shared by the Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(c) -> Column:
    """Numbers become literals, names become columns, Columns pass through."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


# Python float comparisons are False whenever a NaN is involved, while Spark
# orders NaN above every number. These keep Python's results.
def py_gt(a: Column, b: Column) -> Column:
    return (a > b) & ~F.isnan(a) & ~F.isnan(b)


def py_lt(a: Column, b: Column) -> Column:
    return (a < b) & ~F.isnan(a) & ~F.isnan(b)


def py_le(a: Column, b: Column) -> Column:
    return (a <= b) & ~F.isnan(a) & ~F.isnan(b)


def py_max(a: Column, b: Column) -> Column:
    """Python ``max(a, b)``: ``b`` only when ``b > a``."""
    return F.when(py_gt(b, a), b).otherwise(a)


def py_min(a: Column, b: Column) -> Column:
    """Python ``min(a, b)``: ``b`` only when ``b < a``."""
    return F.when(py_lt(b, a), b).otherwise(a)


def report_double(c: Column, digits: int = 9) -> Column:
    """Round for reports; maps -0.0 to 0.0 so equal values print equally."""
    r = F.round(c, digits)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)

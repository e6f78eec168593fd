"""Small helpers shared by the column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(value: Column | str) -> Column:
    """A column name or an expression, as an expression."""
    return F.col(value) if isinstance(value, str) else value


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero or NULL."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)


def own_shuffle(*keys: Column | str) -> Column:
    """An extra grouping column, derived from the keys, for an aggregate whose result is joined on those keys.

    It changes no group. Without it Spark joins on the aggregate's own partitioning, and adaptive execution splits a
    hot key's rows only where the join shuffles both of its inputs itself. Grouped results hold one row per key, so
    shuffling them again costs little next to the other side.
    """
    return F.pmod(F.xxhash64(*[as_column(k) for k in keys]), F.lit(2)).alias("_spread")

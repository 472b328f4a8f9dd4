"""Column expressions used across operators; all NULL-safe under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 0.001  # fixed value: keeps guarded divisors away from zero


def change(value: Column, base: Column) -> Column:
    """Relative change against ``base``; NULL where the base is zero."""
    return F.try_divide(value - base, base)


def ratio_minus_one(value: Column, base: Column) -> Column:
    return F.try_divide(value, base) - 1


def guarded_ratio(value: Column, base: Column) -> Column:
    return F.try_divide(value, base + F.lit(EPS))


def all_not_null(names: list[str]) -> Column:
    """True where every named column is non-NULL. NaN counts as present."""
    return reduce(and_, [F.col(n).isNotNull() for n in names])


def one_row(stats: DataFrame) -> Column:
    """A one-row table as a struct column, read through a scalar subquery.

    The struct is planned and run once however many of its fields are used, and
    no join is involved.
    """
    return stats.select(F.struct(*[F.col(c) for c in stats.columns])).scalar()

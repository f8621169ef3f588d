"""Arithmetic columns."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_sum(columns: Sequence[str | Column]) -> Column:
    """Sum across columns of one row; one missing addend makes the sum missing."""
    return reduce(operator.add, [F.col(c) if isinstance(c, str) else c for c in columns])


def cyclic_distance(a: str | Column, b: str | Column, period: int) -> Column:
    """Shortest way between two positions on a circle of ``period`` steps."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    gap = F.abs(a - b)
    return F.least(gap, F.lit(period) - gap)


def ratio(top: Column, bottom: Column, default: float | None = None) -> Column:
    """Division that gives ``default`` (else missing) for a zero denominator."""
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value if default is None else F.coalesce(value, F.lit(default))


def percent(share: Column, digits: int | None = 2) -> Column:
    """A 0..1 share as a percentage, rounded half up unless ``digits`` is None."""
    value = share * 100.0
    return value if digits is None else F.round(value, digits)


def weighted_sum(columns: Sequence[str], weights: Sequence[float], intercept: float = 0.0) -> Column:
    """Linear score over plain columns."""
    terms = [F.col(c) * F.lit(float(w)) for c, w in zip(columns, weights, strict=True)]
    return reduce(operator.add, terms, F.lit(float(intercept)))


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))

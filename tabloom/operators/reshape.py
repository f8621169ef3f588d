"""Changing the shape of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt_groups(
    df: DataFrame,
    groups: Mapping[str, Column],
    keep: Sequence[str],
    *,
    name: str = "device_type",
    value: str = "power_value",
) -> DataFrame:
    """One row per (row, group): ``keep`` columns, the group name and its value.

    All groups come out of a single scan.
    """
    kept = [F.col(c) for c in keep]
    wide = df.select(*kept, *[expr.cast("double").alias(group) for group, expr in groups.items()])
    return wide.unpivot(list(keep), list(groups), name, value)


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, duplicates kept, columns matched by name."""
    return reduce(DataFrame.unionByName, tables)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()

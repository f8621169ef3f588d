"""Deriving, choosing and cleaning columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import numeric


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or overwrite columns in one projection."""
    return df.withColumns(dict(columns))


def constant(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def sum_columns(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Add ``out``, the sum of ``columns``; missing if any of them is."""
    return df.withColumn(out, numeric.row_sum(columns))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows where none of ``columns`` is NULL or NaN.

    Written as plain predicates, which reach the file scan; ``na.drop`` does not.
    """
    columns = list(columns or df.columns)
    present = [F.col(c).isNotNull() for c in columns]
    fractional = (T.DoubleType, T.FloatType)
    numbers = [~F.isnan(c) for c in columns if isinstance(df.schema[c].dataType, fractional)]
    return df.filter(reduce(lambda a, b: a & b, present + numbers))


def rows_at(df: DataFrame, position: str, positions: Sequence[int]) -> DataFrame:
    """Rows whose index column holds one of ``positions``."""
    return df.filter(F.col(position).isin(*positions))


def top_rows(df: DataFrame, order: Sequence[str | Column], rows: int) -> DataFrame:
    """First ``rows`` rows in the given order, without a full sort."""
    return df.orderBy(*order).limit(rows)


def sorted_report(df: DataFrame, order: Sequence[str | Column], columns: Sequence[str | Column]) -> DataFrame:
    """A report ordered by columns that need not be part of it."""
    return df.orderBy(*order).select(*columns)

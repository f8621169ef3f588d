"""Descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.operators.quantiles import exact_quantiles


def spreads(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population standard deviation of all columns, as rows (feature, spread), in one pass."""
    wide = df.agg(*[F.stddev_pop(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "spread")


def top_spread_table(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` columns that vary most; ties keep the order of ``columns``."""
    position = F.array_position(F.array(*map(F.lit, columns)), F.col("feature"))
    return spreads(df, columns).orderBy(F.desc_nulls_last("spread"), position).limit(k)


def top_spread_columns(df: DataFrame, columns: Sequence[str], k: int) -> list[str]:
    """Names of the ``k`` columns that vary most, for plans whose schema depends on the data."""
    return [row["feature"] for row in top_spread_table(df, columns, k).collect()]


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, exact quartiles, max."""
    present = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    makers = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    facts = df.agg(
        *[make(x).alias(f"{name}_{i}") for i, x in enumerate(present.values()) for name, make in makers.items()]
    ).first()
    counts = {c: facts[f"n_{i}"] for i, c in enumerate(columns)}
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75), counts=counts)
    rows = []
    for i, c in enumerate(columns):
        row = {"feature": c, **{name: facts[f"{name}_{i}"] for name in makers}}
        row.update(zip(("q1", "median", "q3"), quartiles[c], strict=True))
        rows.append(row)
    schema = pa.schema(
        [("feature", pa.string()), ("n", pa.int64())]
        + [(name, pa.float64()) for name in ("mean", "std", "min", "q1", "median", "q3", "max")]
    )
    return runtime.local_table(df.sparkSession, rows, schema)


def box_stats(df: DataFrame, columns: Sequence[str], *, reach: float = 1.5) -> DataFrame:
    """One row per column: quartiles, whisker ends and number of values beyond the whiskers.

    A whisker ends at the last value within ``reach`` times the quartile distance.
    """
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    makers = []
    for i, c in enumerate(columns):
        q1, _, q3 = quartiles[c]
        x = F.col(c).cast("double")
        if q1 is None:
            makers += [F.lit(None).cast("double").alias(f"{n}_{i}") for n in ("low", "high")]
            makers.append(F.lit(0).cast("long").alias(f"out_{i}"))
            continue
        fence = reach * (q3 - q1)
        near = (x >= F.lit(q1 - fence)) & (x <= F.lit(q3 + fence)) & ~F.isnan(x)
        # a whisker never ends inside the box
        makers.append(F.least(F.min(F.when(near, x)), F.lit(q1)).alias(f"low_{i}"))
        makers.append(F.greatest(F.max(F.when(near, x)), F.lit(q3)).alias(f"high_{i}"))
        makers.append(F.count_if(~near & ~F.isnan(x)).alias(f"out_{i}"))
    facts = df.agg(*makers).first()
    rows = [
        {
            "feature": c,
            **dict(zip(("q1", "median", "q3"), quartiles[c], strict=True)),
            "whisker_low": facts[f"low_{i}"],
            "whisker_high": facts[f"high_{i}"],
            "outliers": facts[f"out_{i}"],
        }
        for i, c in enumerate(columns)
    ]
    schema = pa.schema(
        [("feature", pa.string())]
        + [(name, pa.float64()) for name in ("q1", "median", "q3", "whisker_low", "whisker_high")]
        + [("outliers", pa.int64())]
    )
    return runtime.local_table(df.sparkSession, rows, schema)

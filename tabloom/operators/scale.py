"""Feature scaling: measure on one table, apply to another."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Scaling:
    """Per column: subtract ``centers``, divide by ``widths``."""

    columns: tuple[str, ...]
    centers: tuple[float, ...]
    widths: tuple[float, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the columns by their scaled values; a plain projection."""
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(center)) / F.lit(width)
                for c, center, width in zip(self.columns, self.centers, self.widths, strict=True)
            }
        )


def _scaling(columns: Sequence[str], centers: Sequence[float | None], widths: Sequence[float | None]) -> Scaling:
    return Scaling(
        tuple(columns),
        tuple(0.0 if c is None else float(c) for c in centers),
        tuple(float(w) if w else 1.0 for w in widths),
    )


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Mean 0 and population deviation 1; a constant column is only centred."""
    facts = df.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    k = len(columns)
    return _scaling(columns, facts[:k], facts[k:])


def fit_robust(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Median 0 and quartile distance 1; a zero distance divides by 1."""
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    return _scaling(
        columns,
        [quartiles[c][1] for c in columns],
        [None if quartiles[c][0] is None else quartiles[c][2] - quartiles[c][0] for c in columns],
    )

"""Exact quantiles of very large columns.

No column is sorted as a whole. A sketch brackets the wanted order statistic, one pass counts what lies below and inside the bracket, and this repeats
until the open bracket holds few rows. A value that fills a large part of the column ends
up as a border of the bracket and is settled by its count alone, so it is never collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import runtime

# Values that one task gathers in the end, over all columns and brackets.
GATHERED_ROWS = 50_000

_SKETCH = 5_000  # accuracy of percentile_approx: rank error is rows / _SKETCH
_SLACK = 2 / _SKETCH  # distance of the bracket from the wanted rank, as a share of the rows


@dataclass
class _Target:
    """An order statistic being narrowed: it lies in the open interval (low, high)."""

    column: str
    rank: int  # 1-based among the present values
    low: float | None
    high: float | None
    below: int  # values <= low
    inside: int  # values strictly inside
    value: float | None = None

    def mask(self):
        x = F.col(self.column)
        keep = x.isNotNull() & ~F.isnan(x)
        if self.low is not None:
            keep = keep & (x > F.lit(self.low))
        if self.high is not None:
            keep = keep & (x < F.lit(self.high))
        return keep

    def settle(self, borders: list[tuple[float, int, int]]) -> None:
        """Narrow by borders given as (value, inside values below it, inside values equal)."""
        low, high, start, end = self.low, self.high, self.below, self.below + self.inside
        for value, less, equal in sorted(borders):
            first, last = self.below + less + 1, self.below + less + equal
            if equal and first <= self.rank <= last:
                self.value = value
                return
            if self.rank > last and last >= start:
                low, start = value, last
            elif self.rank < first and first - 1 <= end:
                if high is None or value < high:
                    high, end = value, first - 1
        self.low, self.high, self.below, self.inside = low, high, start, end - start


def order_statistics(df: DataFrame, wanted: dict[str, set[int]], counts: dict[str, int]) -> dict[tuple[str, int], float]:
    """Exact 1-based order statistics of double columns; ``counts`` holds present values."""
    targets = [
        _Target(c, r, None, None, 0, counts[c]) for c in wanted for r in sorted(wanted[c]) if 1 <= r <= counts[c]
    ]
    # all brackets are gathered in the same task at the end, so they share its limit
    limit = max(GATHERED_ROWS // max(len(targets), 1), 1)
    while True:
        open_targets = [t for t in targets if t.value is None]
        wide = [t for t in open_targets if t.inside > limit]
        if not wide:
            break
        # targets with the same bracket share one sketch and one set of counts
        brackets: dict[tuple, list[_Target]] = {}
        for t in wide:
            brackets.setdefault((t.column, t.low, t.high), []).append(t)
        sketches = []
        for i, group in enumerate(brackets.values()):
            t = group[0]
            shares = {(g.rank - g.below) / g.inside + d for g in group for d in (-_SLACK, _SLACK)}
            fractions = sorted({min(1.0, max(0.0, share)) for share in shares})
            sketches.append(
                F.percentile_approx(F.when(t.mask(), F.col(t.column)), fractions, _SKETCH).alias(f"s{i}")
            )
        found = df.agg(*sketches).first()
        borders = [sorted(set(values)) for values in found]
        tallies = []
        for values, group in zip(borders, brackets.values(), strict=True):
            t = group[0]
            x, mask = F.col(t.column), t.mask()
            for value in values:
                tallies.append(F.count_if(mask & (x < F.lit(value))).alias(f"c{len(tallies)}"))
                tallies.append(F.count_if(mask & (x == F.lit(value))).alias(f"c{len(tallies)}"))
        counted = iter(df.agg(*tallies).first())
        for values, group in zip(borders, brackets.values(), strict=True):
            cuts = [(value, next(counted), next(counted)) for value in values]
            for t in group:
                t.settle(cuts)
    rest = [t for t in targets if t.value is None]
    if rest:
        # every interval is counted to hold few values; equal ones share a pass
        spans: dict[tuple, list[_Target]] = {}
        for t in rest:
            spans.setdefault((t.column, t.low, t.high), []).append(t)
        picks = []
        for group in spans.values():
            inside = F.sort_array(F.collect_list(F.when(group[0].mask(), F.col(group[0].column))))
            picks += [F.element_at(inside, t.rank - t.below).alias(f"p{len(picks) + i}") for i, t in enumerate(group)]
        row = df.agg(*picks).first()
        for t, value in zip((t for group in spans.values() for t in group), row, strict=True):
            t.value = value
    return {(t.column, t.rank): t.value for t in targets}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    plotting: float = 1.0,
    counts: dict[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of each column, missing values left out.

    ``plotting`` is the plotting-position constant used on both sides: 1.0 interpolates
    linearly between order statistics, 0.4 gives the unbiased-quantile variant. ``counts``
    saves a pass where the numbers of present values are known.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    numbers = runtime.dealt(numbers, *columns)  # read by several passes
    if counts is None:
        present = numbers.agg(*[F.count_if(F.col(c).isNotNull() & ~F.isnan(c)).alias(c) for c in columns]).first()
        counts = {c: present[i] for i, c in enumerate(columns)}
    spots: dict[tuple[str, float], tuple[int, int, float]] = {}
    wanted: dict[str, set[int]] = {c: set() for c in columns}
    for c in columns:
        n = counts[c]
        for p in probabilities:
            if not n:
                continue
            h = n * p + plotting + p * (1 - 2 * plotting)
            k = min(max(math.floor(h), 1), max(n - 1, 1))
            spots[c, p] = (k, min(k + 1, n), min(max(h - k, 0.0), 1.0))
            wanted[c] |= set(spots[c, p][:2])
    values = order_statistics(numbers, wanted, counts)
    result: dict[str, list[float | None]] = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            if (c, p) not in spots:
                result[c].append(None)
                continue
            a, b, share = spots[c, p]
            low, high = values[c, a], values[c, b]
            result[c].append(low if share == 0.0 else low + (high - low) * share)
    return result

"""Hashes that give the same number in every engine, session and partition layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(columns: Sequence[str], seed: int) -> Column:
    """Digest of the seed and the key; with several columns, each value comes with its length.

    A missing value is not the empty text, and ``("a|b", "c")`` is not ``("a", "b|c")``.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
    if len(parts) > 1:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash32(columns: Sequence[str], seed: int) -> Column:
    """Uniform integer in [0, 2**32)."""
    return F.conv(F.substring(_digest(columns, seed), 1, 8), 16, 10).cast("long")


def hash60(columns: Sequence[str], seed: int) -> Column:
    """Uniform integer in [0, 2**60), wide enough to order rows by."""
    return F.conv(F.substring(_digest(columns, seed), 1, 15), 16, 10).cast("long")

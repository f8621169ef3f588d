"""Reproducible splits and folds.

All of them depend on row keys only, never on partitioning, so an executor loss or another
file layout cannot move a row to the other side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import hashing
from tabloom.operators import classes, rank


def hash_split(
    df: DataFrame,
    key: Sequence[str],
    fractions: Mapping[str, float],
    seed: int,
    *,
    out: str = "split",
) -> DataFrame:
    """Name the side of each row by the hash of its key; no shuffle, sizes are approximate.

    Rows with equal keys share a side. Give the key of the source row to keep all rows
    made from it together.
    """
    edges, reached = [], 0.0
    for name, fraction in fractions.items():
        reached += fraction
        edges.append((name, math.floor(reached / math.fsum(fractions.values()) * 2**32 + 0.5)))
    position = hashing.hash32(key, seed)
    side = F.lit(edges[-1][0])
    for name, edge in reversed(edges[:-1]):
        side = F.when(F.col("hash__position") < F.lit(edge), F.lit(name)).otherwise(side)
    return df.withColumn("hash__position", position).withColumn(out, side).drop("hash__position")


def exact_split(
    df: DataFrame,
    key: Sequence[str],
    fraction: float,
    seed: int,
    *,
    names: tuple[str, str] = ("train", "test"),
    out: str = "split",
) -> DataFrame:
    """Random split of which the first side has exactly ``int(fraction * rows)`` rows."""
    ranked = rank.hash_rank(df, "split__rank", key, seed, total="split__rows")
    quota = F.floor(F.lit(fraction) * F.col("split__rows"))
    side = F.when(F.col("split__rank") <= quota, F.lit(names[0])).otherwise(F.lit(names[1]))
    return ranked.withColumn(out, side).drop("split__rank", "split__rows")


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    label: str,
    test_fraction: float,
    seed: int,
    *,
    out: str = "split",
) -> DataFrame:
    """Random split with exactly ``ceil(test_fraction * rows)`` test rows and equal class shares."""
    train = lambda rows: rows - math.ceil(round(test_fraction * rows, 9))
    ranked = rank.hash_rank(df, "split__rank", key, seed, within=[label])
    marked = classes.with_values(ranked, label, classes.quotas(df, label, train, "split__quota"))
    side = F.when(F.col("split__rank") <= F.col("split__quota"), F.lit("train")).otherwise(F.lit("test"))
    return marked.withColumn(out, side).drop("split__rank", "split__quota")


def stratified_folds(
    df: DataFrame,
    key: Sequence[str],
    label: str,
    folds: int,
    seed: int,
    *,
    out: str = "fold",
) -> DataFrame:
    """Shuffled folds 0 .. ``folds`` - 1 with equal class shares and near-equal sizes.

    Rows are dealt round robin through all classes in turn, so fold sizes differ by one
    row at most.
    """
    ranked = rank.hash_rank(df, "fold__rank", key, seed, within=[label])
    marked = classes.with_values(ranked, label, classes.starts(df, label, "fold__start"))
    dealt = (F.col("fold__start") + F.col("fold__rank") - 1) % F.lit(folds)
    return marked.withColumn(out, dealt.cast("int")).drop("fold__rank", "fold__start")

"""Explaining models with tables."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.operators import metrics, models, rank, trees
from tabloom.operators.quantiles import exact_quantiles

Score = Callable[[DataFrame], DataFrame]

_WEIGHT_SCHEMA = pa.schema([("feature", pa.string()), ("value", pa.float64())])


def _per_feature(df: DataFrame, features: Sequence[str], values: Iterable[float], out: str) -> DataFrame:
    rows = [{"feature": f, "value": float(v)} for f, v in zip(features, values, strict=True)]
    table = runtime.local_table(df.sparkSession, rows, _WEIGHT_SCHEMA)
    return table.select("feature", F.col("value").alias(out)).orderBy(F.desc(out), "feature")


def coefficient_table(df: DataFrame, fitted: models.Fitted) -> DataFrame:
    """Coefficients of a logistic regression, largest first."""
    return _per_feature(df, fitted.features, fitted.model.coefficients.toArray(), "coefficient")


def impurity_importance(df: DataFrame, fitted: models.Fitted | trees.NodeForest) -> DataFrame:
    """Mean decrease in impurity per feature of a forest or tree, largest first; sums to 1."""
    if isinstance(fitted, trees.NodeForest):
        return trees.importance(df.sparkSession, fitted)
    return _per_feature(df, fitted.features, fitted.model.featureImportances.toArray(), "importance")


def multipliers(rows: int, repeats: Sequence[int]) -> list[int]:
    """For each repeat a prime that does not divide ``rows``."""
    found, candidate = [], 100_003
    while len(found) <= max(repeats, default=-1):
        if rows % candidate and all(candidate % d for d in range(3, math.isqrt(candidate) + 1, 2)):
            found.append(candidate)
        candidate += 2
    return [found[t] for t in repeats]


def with_donors(df: DataFrame, place: str, rows: int, repeats: Sequence[int], features: Sequence[str]) -> DataFrame:
    """Pair every row with a donor row, once per repeat.

    ``place`` numbers the rows 0 .. ``rows`` - 1 in random order. The donor of row r in
    repeat t stands at ``multiplier * (r + t + 1) mod rows``; the multiplier has no factor
    in common with ``rows``, so every row donates exactly once per repeat. Donated values
    arrive as ``donor_<feature>``. Both sides are spread evenly over the places.
    """
    factors = multipliers(rows, repeats)
    steps = F.array(
        *[
            F.struct(F.lit(t).alias("repeat"), F.lit(a).cast("long").alias("factor"))
            for t, a in zip(repeats, factors, strict=True)
        ]
    )
    receivers = df.select("*", F.explode(steps).alias("step")).select(
        *df.columns,
        F.col("step.repeat").alias("repeat"),
        # row numbers and factor fit 63 bits up to 9e13 rows
        ((F.col("step.factor") * ((F.col(place) + F.col("step.repeat") + 1) % rows)) % rows).alias("donor__place"),
    )
    donors = df.select(F.col(place).alias("donor__place"), *[F.col(f).alias(f"donor_{f}") for f in features])
    # keep all partitions, however few bytes they hold: scoring multiplies the rows after the join
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    receivers, donors = receivers.repartition(tasks, "donor__place"), donors.repartition(tasks, "donor__place")
    return receivers.join(donors, "donor__place").drop("donor__place")


def permutation_scores(
    df: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    label: str,
    score: Score,
    *,
    repeats: int = 30,
    seed: int = 42,
    per_job: int = 5,
) -> DataFrame:
    """Rows (feature, repeat, drop): accuracy lost when a feature takes donor values.

    All features of a repeat share one donor assignment, so a repeat moves each row once.
    ``score`` adds a ``prediction`` column from the feature columns. The result holds
    features x repeats rows; ``per_job`` repeats are shuffled at a time, which bounds the
    disk a large table needs.
    """
    ranked = rank.hash_rank(df.select(*key, *features, label), "place", key, seed)
    placed = ranked.select((F.col("place") - 1).alias("place"), *features, label)
    placed = runtime.store(placed, "placed")  # numbered once, read by every repeat
    facts = score(placed).agg(
        F.count("*"), F.avg(F.when(F.col(label) == F.col("prediction"), 1.0).otherwise(0.0))
    ).first()
    rows, base = facts
    done = []
    for start in range(0, repeats, per_job):
        donated = with_donors(placed, "place", rows, range(start, min(start + per_job, repeats)), features)
        # one row per feature to replace; the aggregation combines inside the task
        swapped = donated.select("*", F.explode(F.array(*map(F.lit, features))).alias("feature")).select(
            "feature",
            "repeat",
            label,
            *[F.when(F.col("feature") == f, F.col(f"donor_{f}")).otherwise(F.col(f)).alias(f) for f in features],
        )
        right = F.avg(F.when(F.col(label) == F.col("prediction"), 1.0).otherwise(0.0))
        done.append(
            score(swapped)
            .groupBy("feature", "repeat")
            .agg((F.lit(base) - right).alias("drop"))
            .toArrow()
        )
    return df.sparkSession.createDataFrame(pa.concat_tables(done))


def permutation_importance(scores: DataFrame) -> DataFrame:
    """Mean and deviation of the lost accuracy per feature, largest first."""
    table = metrics.mean_and_spread(scores, ["feature"], "drop")
    return table.select(
        "feature",
        F.col("drop_mean").alias("importance"),
        F.col("drop_std").alias("importance_std"),
    ).orderBy(F.desc("importance"), "feature")


def dependence_grid(df: DataFrame, features: Sequence[str], *, points: int = 100) -> dict[str, list[float]]:
    """Grid per feature: its values if fewer than ``points``, else even steps from the 5th to the 95th percentile."""
    numbers = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    present = {f: F.when(~F.isnan(f), F.col(f)) for f in features}
    # a sketch skips the features with far more values; the few it lets through are counted exactly
    guess = numbers.agg(*[F.approx_count_distinct(x, 0.05).alias(f) for f, x in present.items()]).first()
    close = [f for f in features if guess[f] < 2 * points]
    grid: dict[str, list[float]] = {}
    if close:
        long = numbers.select(*close).unpivot([], close, "feature", "x").filter(F.col("x").isNotNull() & ~F.isnan("x"))
        values = runtime.store(long.distinct(), "values")
        counts = values.groupBy("feature").agg(F.count("*").alias("n"))
        few = [r["feature"] for r in counts.filter(F.col("n") < points).collect()]
        for row in values.filter(F.col("feature").isin(few)).collect() if few else []:  # fewer than features * points
            grid.setdefault(row["feature"], []).append(row["x"])
    grid = {f: sorted(v) for f, v in grid.items()}
    rest = [f for f in features if f not in grid]
    if rest:
        ends = exact_quantiles(df, rest, (0.05, 0.95), plotting=0.4)
        for f in rest:
            low, high = ends[f]
            step = (high - low) / (points - 1)
            grid[f] = [low + step * i for i in range(points - 1)] + [high]
    return grid


def partial_dependence(
    df: DataFrame,
    features: Sequence[str],
    score: Score,
    *,
    grid: dict[str, list[float]] | None = None,
    points: int = 100,
) -> DataFrame:
    """Rows (feature, grid, mean_probability): mean ``p1`` when a feature is set to a grid value.

    Grid values are literals that every row is expanded with inside its task, in a single
    scan; the mean combines there too, so a task shuffles features x points rows at most.
    """
    grid = grid or dependence_grid(df, features, points=points)
    listed = json.dumps([{"feature": f, "grid": float(v)} for f in features for v in grid[f]])
    # one text literal, folded into an array once, is far quicker to plan than a literal per value
    spots = F.from_json(F.lit(listed), "array<struct<feature:string,grid:double>>")
    moved = runtime.dealt(df.select(*features), *features).select("*", F.explode(spots).alias("spot")).select(
        "spot.feature",
        "spot.grid",
        *[F.when(F.col("spot.feature") == f, F.col("spot.grid")).otherwise(F.col(f)).alias(f) for f in features],
    )
    return score(moved).groupBy("feature", "grid").agg(F.avg("p1").alias("mean_probability"))

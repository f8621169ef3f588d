"""Cross-validation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.operators import metrics, models, scale, split


def fold_predictions(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    folds: int,
    fit: Callable[[DataFrame], models.Fitted],
    *,
    fold: str = "fold",
    scale_before: bool = False,
) -> DataFrame:
    """Every row scored by the model that did not see its fold.

    Features are standardised with the training part of each fold. ``scale_before``
    standardises once with all rows instead, which lets the tested rows influence it.
    """
    if scale_before:
        df = scale.fit_standard(df, features).apply(df)
    parts = []
    for i in range(folds):
        train, held = df.filter(F.col(fold) != i), df.filter(F.col(fold) == i)
        if not scale_before:
            scaling = scale.fit_standard(train, features)
            train, held = scaling.apply(train), scaling.apply(held)
        parts.append(fit(train).apply(held))
    return reduce(DataFrame.unionByName, parts)


def cross_validate(
    df: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    label: str,
    fit: Callable[[DataFrame], models.Fitted],
    *,
    folds: int = 5,
    seed: int = 42,
    scale_before: bool = False,
) -> DataFrame:
    """Rows (metric, mean) over stratified folds; all folds are scored in one aggregation.

    The rows are stored with their folds first: every fit reads them many times, and a
    short lineage keeps the jobs of its iterations small.
    """
    columns = df.select(*key, *features, label)
    placed = runtime.store(split.stratified_folds(columns, key, label, folds, seed), "folds")
    scored = fold_predictions(placed, features, label, folds, fit, scale_before=scale_before)
    counts = metrics.binary_counts(scored, label, "prediction", ["fold"])
    return metrics.mean_over(metrics.binary_scores(counts, ["fold"]), metrics.BINARY_METRICS)

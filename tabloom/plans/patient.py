"""Binary classification over a table of numeric features: statistics, models, explanation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.operators import crossval, explain, metrics, models, scale, split, trees
from tabloom.sources import schemas, tables


@dataclass(frozen=True)
class Study:
    """A labelled table, the key of its rows and its feature columns."""

    table: DataFrame
    key: tuple[str, ...]
    features: tuple[str, ...]
    label: str

    def sides(self, *, test_fraction: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
        """Train and test rows with equal class shares.

        The split rows are stored: everything that follows reads them several times, and
        ranking them anew for each pass would cost a shuffle each.
        """
        columns = self.table.select(*self.key, *self.features, self.label)
        parts = split.stratified_split(columns, self.key, self.label, test_fraction, seed)
        parts = runtime.store(parts, "sides")
        return parts.filter(F.col("split") == "train"), parts.filter(F.col("split") == "test")


def read_study(spark: SparkSession, path: str) -> Study:
    """The patient CSV as a study; rows get their position as key, for the file has none."""
    table = tables.number_rows(tables.read_csv(spark, path, schemas.PATIENT_SCHEMA))
    *features, label = schemas.PATIENT_SCHEMA.names
    return Study(table, ("row",), tuple(features), label)


def scaled_sides(study: Study, **options) -> tuple[DataFrame, DataFrame]:
    """Both sides standardised with the statistics of the train side."""
    train, test = study.sides(**options)
    scaling = scale.fit_standard(train, study.features)
    return scaling.apply(train), scaling.apply(test)


def fit_balanced_logit(train: DataFrame, features: Sequence[str], label: str) -> models.Fitted:
    return models.fit_logit(
        models.balanced(train, label), features, label, weight="weight", inverse_penalty=1.0
    )


# Fewest train rows of a node that is split.
MIN_SPLIT = 8


def grow_forest(train: DataFrame, study: Study, *, balance: bool = False, seed: int = 42) -> models.Fitted:
    """100 trees of depth 5 with leaves of at least 3 rows."""
    if balance:
        train = models.balanced(train, study.label)
    return models.fit_forest(
        models.fixed_layout(train, study.key),
        study.features,
        study.label,
        trees=100,
        depth=5,
        min_leaf=3,
        subset="sqrt",
        seed=seed,
        weight="weight" if balance else None,
    )


def grow_balanced_tree(train: DataFrame, study: Study, *, seed: int = 42) -> models.Fitted:
    train = models.fixed_layout(models.balanced(train, study.label), study.key)
    return models.fit_tree(train, study.features, study.label, depth=5, min_leaf=3, seed=seed, weight="weight")


def limited(train: DataFrame, fitted: models.Fitted) -> trees.NodeForest:
    """The model without splits of nodes that fewer than ``MIN_SPLIT`` train rows reach."""
    return trees.collapsed(trees.with_rows(trees.read_nodes(train.sparkSession, fitted), train), MIN_SPLIT)


def fit_forest(train: DataFrame, study: Study, *, balance: bool = False, seed: int = 42) -> trees.NodeForest:
    """The forest with its minimum split size."""
    return limited(train, grow_forest(train, study, balance=balance, seed=seed))


def fit_balanced_tree(train: DataFrame, study: Study, *, seed: int = 42) -> trees.NodeForest:
    return limited(train, grow_balanced_tree(train, study, seed=seed))


def report(study: Study, scored: DataFrame) -> DataFrame:
    return metrics.classification_report(scored, study.label, "prediction", "p1")


def cross_validation(study: Study, *, folds: int = 5, seed: int = 42, scale_before: bool = False) -> DataFrame:
    """Mean scores of the balanced logistic regression over stratified folds."""
    return crossval.cross_validate(
        study.table,
        study.key,
        study.features,
        study.label,
        lambda train: fit_balanced_logit(train, study.features, study.label),
        folds=folds,
        seed=seed,
        scale_before=scale_before,
    )


def permutation_table(
    study: Study, train: DataFrame, fitted: models.Fitted | trees.NodeForest, *, repeats: int = 30, seed: int = 42
) -> DataFrame:
    scores = explain.permutation_scores(
        train, study.key, study.features, study.label, fitted.apply, repeats=repeats, seed=seed
    )
    return explain.permutation_importance(scores)


def dependence_table(study: Study, train: DataFrame, fitted: models.Fitted, *, points: int = 100) -> DataFrame:
    return explain.partial_dependence(train, study.features, fitted.apply, points=points)

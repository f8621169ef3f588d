"""Fitting and applying Spark ML classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import classes


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Collect feature columns in a vector; a missing value is an error, so clean first."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


# Rows per task of a fit that depends on where rows sit.
ROWS_PER_TASK = 250_000


def fixed_layout(df: DataFrame, key: Sequence[str], rows_per_task: int | None = None) -> DataFrame:
    """Place and order rows by their key, in as many partitions as their number asks for.

    Seeded tree training also depends on where rows sit. After this step a fit gives the
    same trees for the same rows, whatever their layout and the cluster; more rows make more
    partitions. Give a stored table, for its rows are counted first.
    """
    partitions = max(1, -(-df.count() // (rows_per_task or ROWS_PER_TASK)))
    return df.repartition(partitions, *key).sortWithinPartitions(*key)


@dataclass(frozen=True)
class Fitted:
    """A fitted classifier with the columns it reads."""

    model: Model
    features: tuple[str, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (class) and ``p1`` (probability of class 1)."""
        scored = self.model.transform(assemble(df, self.features, "features__vector"))
        return scored.withColumn("p1", vector_to_array("probability").getItem(1)).drop(
            "features__vector", "rawPrediction", "probability"
        )


def _fit(estimator, df: DataFrame, features: Sequence[str], label: str, weight: str | None) -> Fitted:
    columns = ["features__vector", label] + ([weight] if weight else [])
    estimator = estimator.setFeaturesCol("features__vector").setLabelCol(label)
    if weight:
        estimator = estimator.setWeightCol(weight)
    # a fit reads its input several times before it caches its own form of it
    data = assemble(df, features, "features__vector").select(*columns).persist()
    try:
        return Fitted(estimator.fit(data), tuple(features))
    finally:
        data.unpersist()


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    trees: int = 30,
    depth: int = 5,
    min_leaf: int = 1,
    subset: str = "auto",
    bootstrap: bool = True,
    seed: int = 42,
    weight: str | None = None,
) -> Fitted:
    """Random forest, by default with bootstrap samples; always seeded."""
    forest = RandomForestClassifier(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset,
        bootstrap=bootstrap,
        seed=seed,
    )
    return _fit(forest, df, features, label, weight)


def fit_tree(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    depth: int = 5,
    min_leaf: int = 3,
    seed: int = 42,
    weight: str | None = None,
) -> Fitted:
    tree = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed)
    return _fit(tree, df, features, label, weight)


def fit_logit(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    weight: str | None = None,
    inverse_penalty: float | None = None,
    iterations: int = 100,
    tolerance: float = 1e-6,
) -> Fitted:
    """Logistic regression.

    Without ``inverse_penalty`` it is not regularised. With it, half the squared
    coefficients are added to ``inverse_penalty`` times the summed (weighted) loss; Spark
    averages the loss, so its penalty is divided by the weight sum.
    """
    logit = LogisticRegression(maxIter=iterations, tol=tolerance)
    if inverse_penalty is not None:
        total = df.agg(F.sum(weight).cast("double") if weight else F.count("*").cast("double")).first()[0]
        logit = logit.setRegParam(1.0 / (inverse_penalty * total)).setElasticNetParam(0.0).setStandardization(False)
    return _fit(logit, df, features, label, weight)


def score_equations(
    df: DataFrame, fitted: Fitted, label: str, *, weight: str | None = None, inverse_penalty: float | None = None
) -> DataFrame:
    """Rows (feature, fitted, observed): both sides are equal at the optimum of a logistic regression.

    Per weight, ``observed`` is the sum of label times feature, and ``fitted`` the sum of probability times feature plus
    what the penalty pulls; their difference is the gradient of the loss. The intercept is the feature
    ``(intercept)`` with value 1, without a penalty. One aggregation over the scored rows.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    pulls = dict(zip(fitted.features, fitted.model.coefficients.toArray().tolist(), strict=True)) if inverse_penalty else {}
    values = {f: F.col(f).cast("double") for f in fitted.features} | {"(intercept)": F.lit(1.0)}
    sides = []
    for i, (feature, x) in enumerate(values.items()):
        pull = F.lit(pulls.get(feature, 0.0) / (inverse_penalty or 1.0))
        sides.append(((F.sum(w * F.col("p1") * x) + pull) / F.sum(w)).alias(f"f{i}"))
        sides.append((F.sum(w * F.col(label) * x) / F.sum(w)).alias(f"o{i}"))
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"f{i}").alias("fitted"), F.col(f"o{i}").alias("observed")) for i, f in enumerate(values)]
    return fitted.apply(df).agg(*sides).select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def balanced(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add weights under which every class counts the same."""
    return classes.with_class_weight(df, label, out)

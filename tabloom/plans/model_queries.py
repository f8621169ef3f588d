"""Fitted models on a design whose optimum is known, so that SQL can check the fits.

The orders fall into nine cells by status and price. With one 0/1 feature per cell but the first,
an unpenalised logistic regression predicts every cell's (weighted) mean, its coefficients are
differences of log odds, and a tree that is deep enough predicts every cell's majority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.operators import crossval, explain, metrics, models, profile
from tabloom.plans.catalog import Catalog
from tabloom.plans.standins import table

CATALOG = Catalog()

_CELLS = tuple(f"{status}{step}" for status in "FOP" for step in range(3))
_FLAGS = tuple(f"in_{c}" for c in _CELLS[1:])
# yes/no features that a tree can combine to cells
_STEPS = ("is_o", "is_p", "over_1", "over_2")

_CELLS_SQL = """cells AS (
  SELECT o_orderkey, o_orderstatus || CAST((o_totalprice > 90000)::INT + (o_totalprice > 180000)::INT AS VARCHAR) AS cell,
    CAST(month(o_orderdate) * 25000 + o_totalprice > 300000 AS INT) AS y FROM orders)"""


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Key, cell, 0/1 label ``y`` and the features; stored, for fits read it many times."""
    price = F.col("o_totalprice")
    over = {"over_1": price > 90000, "over_2": price > 180000}
    cell = F.concat("o_orderstatus", sum(c.cast("int") for c in over.values()).cast("string"))
    base = table(spark, folder, "orders").select(
        "o_orderkey",
        cell.alias("cell"),
        (F.month("o_orderdate") * 25000 + price > 300000).cast("int").alias("y"),
        (F.col("o_orderstatus") == "O").cast("double").alias("is_o"),
        (F.col("o_orderstatus") == "P").cast("double").alias("is_p"),
        *[c.cast("double").alias(n) for n, c in over.items()],
    )
    flags = {f: (F.col("cell") == c).cast("double") for f, c in zip(_FLAGS, _CELLS[1:], strict=True)}
    return runtime.store(base.withColumns(flags), "cells")


def _logit(train: DataFrame, weight: str | None = None) -> models.Fitted:
    return models.fit_logit(train, _FLAGS, "y", weight=weight, iterations=500, tolerance=1e-9)


def _by_cell(scored: DataFrame) -> DataFrame:
    """What a model says about every cell; all rows of a cell get the same."""
    return scored.groupBy("cell").agg(
        F.round(F.min("p1"), 4).alias("p_low"), F.round(F.max("p1"), 4).alias("p_high"), F.max("prediction").alias("prediction")
    )


@CATALOG.query(
    f"""WITH {_CELLS_SQL} SELECT cell, round(avg(y), 4) AS p_low, round(avg(y), 4) AS p_high,
          CASE WHEN avg(y) > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM cells GROUP BY 1"""
)
def cell_logit(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities and classes of a logistic regression."""
    rows = cells(spark, folder)
    return _by_cell(_logit(rows).apply(rows))


_BALANCED_SQL = f"""{_CELLS_SQL}, weighed AS (
  SELECT cell, y, (SELECT count(*) FROM cells) / (2.0 * count(*) OVER (PARTITION BY y)) AS w FROM cells),
  means AS (SELECT cell, sum(y * w) / sum(w) AS p FROM weighed GROUP BY 1)"""


@CATALOG.query(
    f"""WITH {_BALANCED_SQL} SELECT cell, round(p, 4) AS p_low, round(p, 4) AS p_high,
          CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM means"""
)
def cell_logit_balanced(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities and classes of a logistic regression with balanced weights."""
    rows = cells(spark, folder)
    return _by_cell(_logit(models.balanced(rows, "y"), "weight").apply(rows))


@CATALOG.query(
    f"""WITH {_CELLS_SQL}, odds AS (SELECT cell, ln(avg(y) / (1 - avg(y))) AS o FROM cells GROUP BY 1)
        SELECT 'in_' || cell AS feature, round(o - (SELECT o FROM odds WHERE cell = '{_CELLS[0]}'), 4) AS coefficient
        FROM odds WHERE cell <> '{_CELLS[0]}'"""
)
def cell_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficients of a logistic regression, as differences of log odds."""
    rows = cells(spark, folder)
    return explain.coefficient_table(rows, _logit(rows)).withColumn("coefficient", F.round("coefficient", 4))


def _confusion_sql(cells_sql: str, share: str) -> str:
    return f"""WITH {cells_sql}, ruled AS (
          SELECT c.y, CAST(m.p > 0.5 AS INT) AS p FROM cells c JOIN ({share}) m ON m.cell = c.cell)
        SELECT y AS label, count(*) FILTER (p = 0) AS predicted_0, count(*) FILTER (p = 1) AS predicted_1,
          0::BIGINT AS predicted_other FROM ruled GROUP BY 1"""


@CATALOG.query(_confusion_sql(_BALANCED_SQL, "SELECT cell, p FROM means"))
def cell_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion table of a decision tree with balanced weights: the weighted majority of each cell."""
    rows = cells(spark, folder)
    train = models.fixed_layout(models.balanced(rows, "y"), ["o_orderkey"])
    fitted = models.fit_tree(train, _STEPS, "y", depth=6, min_leaf=1, weight="weight")
    return metrics.confusion_matrix(fitted.apply(rows), "y", "prediction", (0, 1))


@CATALOG.query(_confusion_sql(_CELLS_SQL, "SELECT cell, avg(y) AS p FROM cells GROUP BY 1"))
def cell_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion table of a forest of trees that all see every row: the majority of each cell."""
    rows = cells(spark, folder)
    train = models.fixed_layout(rows, ["o_orderkey"])
    fitted = models.fit_forest(train, _STEPS, "y", trees=3, depth=6, subset="all", bootstrap=False)
    return metrics.confusion_matrix(fitted.apply(rows), "y", "prediction", (0, 1))


@CATALOG.query(
    f"""WITH {_CELLS_SQL}, sizes AS (SELECT y, count(*) AS n FROM cells GROUP BY y),
          starts AS (SELECT y, sum(n) OVER (ORDER BY y) - n AS start FROM sizes),
          folded AS (SELECT c.cell, c.y, (t.start - 1 + row_number() OVER (PARTITION BY c.y
              ORDER BY CAST(('0x' || substr(md5('42|' || CAST(c.o_orderkey AS VARCHAR)), 1, 15)) AS UBIGINT), c.o_orderkey)) % 5 AS fold
            FROM cells c JOIN starts t ON c.y = t.y),
          parts AS (SELECT cell, fold, sum(y) AS s, count(*) AS n FROM folded GROUP BY 1, 2),
          rules AS (SELECT p.cell, p.fold, CAST((sum(p.s) OVER (PARTITION BY p.cell) - p.s)
              / (sum(p.n) OVER (PARTITION BY p.cell) - p.n) > 0.5 AS INT) AS p FROM parts p),
          ruled AS (SELECT f.fold, f.y, r.p FROM folded f JOIN rules r ON r.cell = f.cell AND r.fold = f.fold),
          c AS (SELECT fold, CAST(count(*) FILTER (y = 1 AND p = 1) AS DOUBLE) AS tp,
            CAST(count(*) FILTER (y = 0 AND p = 1) AS DOUBLE) AS fp, CAST(count(*) FILTER (y = 0 AND p = 0) AS DOUBLE) AS tn,
            CAST(count(*) FILTER (y = 1 AND p = 0) AS DOUBLE) AS fn FROM ruled GROUP BY 1)
        SELECT 'accuracy' AS metric, round(avg((tp + tn) / (tp + tn + fp + fn)), 6) AS mean FROM c
        UNION ALL SELECT 'balanced_accuracy', round(avg((tp / (tp + fn) + tn / (tn + fp)) / 2), 6) FROM c
        UNION ALL SELECT 'recall', round(avg(tp / (tp + fn)), 6) FROM c
        UNION ALL SELECT 'precision', round(avg(tp / (tp + fp)), 6) FROM c"""
)
def cell_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Mean scores of the logistic regression over five stratified folds."""
    means = crossval.cross_validate(cells(spark, folder), ["o_orderkey"], _FLAGS, "y", _logit)
    return means.withColumn("mean", F.round("mean", 6))


@CATALOG.query(
    f"""WITH {_CELLS_SQL}, p AS (SELECT y, avg(y) OVER (PARTITION BY cell) AS s FROM cells),
          c AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM (SELECT y, round(s, 4) AS s FROM p) GROUP BY 1)
        SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL SELECT s, round(sum(neg) OVER (ORDER BY s DESC) / sum(neg) OVER (), 6),
          round(sum(pos) OVER (ORDER BY s DESC) / sum(pos) OVER (), 6) FROM c"""
)
def cell_roc(spark: SparkSession, folder: str) -> DataFrame:
    """ROC curve of the fitted logistic regression."""
    rows = cells(spark, folder)
    scored = runtime.store(_logit(rows).apply(rows).select("y", F.round("p1", 4).alias("p1")), "scored")
    points = metrics.roc_points(scored, "y", "p1")
    return points.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@CATALOG.query(
    f"""WITH {_CELLS_SQL}, spreads AS (
          SELECT 'is_o' AS f, stddev_pop(CAST(cell LIKE 'O%' AS INT)) AS s FROM cells
          UNION ALL SELECT 'is_p', stddev_pop(CAST(cell LIKE 'P%' AS INT)) FROM cells
          UNION ALL SELECT 'over_1', stddev_pop(CAST(cell NOT LIKE '%0' AS INT)) FROM cells
          UNION ALL SELECT 'over_2', stddev_pop(CAST(cell LIKE '%2' AS INT)) FROM cells),
        top AS (SELECT list(f) AS fs FROM (SELECT f FROM spreads ORDER BY s DESC, f LIMIT 2)),
        keyed AS (SELECT y, array_to_string(list_transform((SELECT fs FROM top), lambda f: CASE f
            WHEN 'is_o' THEN CAST(cell LIKE 'O%' AS INT) WHEN 'is_p' THEN CAST(cell LIKE 'P%' AS INT)
            WHEN 'over_1' THEN CAST(cell NOT LIKE '%0' AS INT) ELSE CAST(cell LIKE '%2' AS INT) END), '') AS k FROM cells),
        means AS (SELECT k, avg(y) AS p, count(*) AS n, sum(y) AS pos FROM keyed GROUP BY 1)
        SELECT (SELECT array_to_string(fs, ',') FROM top) AS features,
          round(sum(CASE WHEN p > 0.5 THEN pos ELSE n - pos END) / sum(n), 6) AS accuracy FROM means"""
)
def cell_top2(spark: SparkSession, folder: str) -> DataFrame:
    """A model on the two features that vary most: a tree, which predicts the majority of their cells."""
    rows = cells(spark, folder)
    features = profile.top_spread_columns(rows, _STEPS, 2)
    fitted = models.fit_tree(models.fixed_layout(rows, ["o_orderkey"]), features, "y", depth=4, min_leaf=1)
    right = metrics.accuracy(fitted.apply(rows), "y", "prediction")
    return right.select(F.lit(",".join(features)).alias("features"), F.round("accuracy", 6).alias("accuracy"))

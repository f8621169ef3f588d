"""Queries of the binary-classification plans on the labelled documents and the events."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.functions import calendar, numeric
from tabloom.operators import explain, metrics, split
from tabloom.plans import patient, standins
from tabloom.plans.catalog import Catalog
from tabloom.plans.standins import DOCUMENT_FEATURES, STUDY_SQL, table

CATALOG = Catalog()

def stored_study(spark: SparkSession, folder: str) -> patient.Study:
    """The study with its features stored, so that texts are tokenized once."""
    study = standins.study(spark, folder)
    return replace(study, table=runtime.store(study.table, "study"))


# A fixed logistic formula, for explanation tables that SQL can check.
_WEIGHTS = (0.0001, -0.0006, 3.0, -0.5, 0.01)
_INTERCEPT = 0.4


def formula(df: DataFrame) -> DataFrame:
    """Score by the fixed formula: columns ``p1`` and ``prediction``."""
    p1 = numeric.logistic(numeric.weighted_sum(DOCUMENT_FEATURES, _WEIGHTS, _INTERCEPT))
    return df.withColumn("p1", p1).withColumn("prediction", F.when(F.col("p1") > 0.5, 1.0).otherwise(0.0))


def _margin_sql(columns: dict[str, str]) -> str:
    terms = [f"{w} * {columns[c]}" for c, w in zip(DOCUMENT_FEATURES, _WEIGHTS, strict=True)]
    return f"({_INTERCEPT} + " + " + ".join(terms) + ")"


_PLAIN_SQL = f"1.0 / (1.0 + exp(-{_margin_sql({c: c for c in DOCUMENT_FEATURES})}))"

_RULED_SQL = "ruled AS (SELECT CAST(dayofweek(ts) IN (0, 6) AS INT) AS y, CAST(value > 60 AS INT) AS p, value AS s FROM events)"


def _ruled(spark: SparkSession, folder: str) -> DataFrame:
    """Weekend label, a fixed rule and its score on the events."""
    return table(spark, folder, "events").select(
        calendar.weekend_flag("ts").alias("y"),
        F.when(F.col("value") > 60, 1.0).otherwise(0.0).alias("p"),
        F.col("value").alias("s"),
    )


_AUC_SQL = """(SELECT sum((fp - prev_fp) * (tp + prev_tp) / 2.0) / (max(tp) * max(fp)) FROM (
  SELECT tp, fp, coalesce(lag(tp) OVER (ORDER BY s DESC), 0) AS prev_tp, coalesce(lag(fp) OVER (ORDER BY s DESC), 0) AS prev_fp
  FROM (SELECT s, CAST(sum(sum(y)) OVER (ORDER BY s DESC) AS DOUBLE) AS tp,
          CAST(sum(sum(1 - y)) OVER (ORDER BY s DESC) AS DOUBLE) AS fp FROM ruled GROUP BY s)))"""


@CATALOG.query(
    f"""WITH {_RULED_SQL}, c AS (
          SELECT CAST(count(*) FILTER (y = 1 AND p = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (y = 0 AND p = 1) AS DOUBLE) AS fp,
            CAST(count(*) FILTER (y = 0 AND p = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (y = 1 AND p = 0) AS DOUBLE) AS fn FROM ruled)
        SELECT 'accuracy' AS metric, round((tp + tn) / (tp + tn + fp + fn), 6) AS value FROM c
        UNION ALL SELECT 'balanced_accuracy', round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) FROM c
        UNION ALL SELECT 'recall', round(tp / (tp + fn), 6) FROM c
        UNION ALL SELECT 'precision', round(tp / (tp + fp), 6) FROM c
        UNION ALL SELECT 'auc', round({_AUC_SQL}, 6)"""
)
def binary_report(spark: SparkSession, folder: str) -> DataFrame:
    """All scores of a fixed rule."""
    report = metrics.classification_report(_ruled(spark, folder), "y", "p", "s")
    return report.withColumn("value", F.round("value", 6))


@CATALOG.query(f"WITH {_RULED_SQL} SELECT round({_AUC_SQL}, 6) AS auc")
def auc(spark: SparkSession, folder: str) -> DataFrame:
    """Area under the ROC curve of a fixed score."""
    return metrics.auc(_ruled(spark, folder), "y", "s").withColumn("auc", F.round("auc", 6))


@CATALOG.query(
    f"""WITH {_RULED_SQL} SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL SELECT s, round(sum(sum(1 - y)) OVER (ORDER BY s DESC) / (SELECT sum(1 - y) FROM ruled), 6),
          round(sum(sum(y)) OVER (ORDER BY s DESC) / (SELECT sum(y) FROM ruled), 6) FROM ruled GROUP BY s"""
)
def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    """ROC curve of a fixed score."""
    points = metrics.roc_points(_ruled(spark, folder), "y", "s")
    return points.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@CATALOG.query(
    """WITH ruled AS (SELECT CAST(dayofweek(ts) IN (0, 6) AS INT) AS y, round(value, 1) AS s FROM events),
          steps AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM ruled GROUP BY s),
          placed AS (SELECT *, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
            lead(pos) OVER (ORDER BY s DESC) AS next_pos, lead(neg) OVER (ORDER BY s DESC) AS next_neg,
            lag(pos) OVER (ORDER BY s DESC) AS last_pos FROM steps)
        SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL SELECT s, round(fp / (SELECT sum(neg) FROM steps), 6), round(tp / (SELECT sum(pos) FROM steps), 6) FROM placed
        WHERE last_pos IS NULL OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg"""
)
def roc_corners(spark: SparkSession, folder: str) -> DataFrame:
    """ROC curve without the points inside straight pieces."""
    ruled = _ruled(spark, folder).withColumn("s", F.round("s", 1))
    points = metrics.roc_points(ruled, "y", "s", corners=True)
    return points.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@CATALOG.query(
    f"""WITH {STUDY_SQL}, scored AS (SELECT quality, {_PLAIN_SQL} AS p1 FROM study)
        SELECT quality AS label, count(*) FILTER (p1 <= 0.5) AS predicted_0, count(*) FILTER (p1 > 0.5) AS predicted_1,
          0::BIGINT AS predicted_other
        FROM scored GROUP BY 1"""
)
def binary_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion table of the fixed formula."""
    scored = formula(standins.labelled_documents(spark, folder))
    return metrics.confusion_matrix(scored, "quality", "prediction", (0, 1))


@CATALOG.query(
    f"""WITH {STUDY_SQL}, sizes AS (SELECT quality, count(*) AS n FROM study GROUP BY 1),
          starts AS (SELECT quality, sum(n) OVER (ORDER BY quality) - n AS start FROM sizes),
          folded AS (SELECT s.quality AS y, CAST({_PLAIN_SQL} > 0.5 AS INT) AS p,
            (t.start - 1 + row_number() OVER (PARTITION BY s.quality
              ORDER BY CAST(('0x' || substr(md5('42|' || CAST(s.doc_id AS VARCHAR)), 1, 15)) AS UBIGINT), s.doc_id)) % 5 AS fold
            FROM study s JOIN starts t ON s.quality = t.quality),
          c AS (SELECT fold, CAST(count(*) FILTER (y = 1 AND p = 1) AS DOUBLE) AS tp,
            CAST(count(*) FILTER (y = 0 AND p = 1) AS DOUBLE) AS fp, CAST(count(*) FILTER (y = 0 AND p = 0) AS DOUBLE) AS tn,
            CAST(count(*) FILTER (y = 1 AND p = 0) AS DOUBLE) AS fn FROM folded GROUP BY 1)
        SELECT 'accuracy' AS metric, round(avg((tp + tn) / (tp + tn + fp + fn)), 6) AS mean FROM c
        UNION ALL SELECT 'balanced_accuracy', round(avg((tp / (tp + fn) + tn / (tn + fp)) / 2), 6) FROM c
        UNION ALL SELECT 'recall', round(avg(tp / (tp + fn)), 6) FROM c
        UNION ALL SELECT 'precision', round(avg(tp / (tp + fp)), 6) FROM c"""
)
def fold_means(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the fixed formula per stratified fold, averaged over the folds."""
    placed = split.stratified_folds(stored_study(spark, folder).table, ["doc_id"], "quality", 5, 42)
    counts = metrics.binary_counts(formula(placed), "quality", "prediction", ["fold"])
    means = metrics.mean_over(metrics.binary_scores(counts, ["fold"]), metrics.BINARY_METRICS)
    return means.withColumn("mean", F.round("mean", 6))


_REPEATS = 5


def _permuted_sql() -> str:
    factors = explain.multipliers(1, range(_REPEATS))
    steps = ", ".join(f"({t}, {a})" for t, a in enumerate(factors))
    picked = ", ".join(f"CASE WHEN f.feature = '{c}' THEN d.{c} ELSE r.{c} END AS {c}" for c in DOCUMENT_FEATURES)
    names = ", ".join(f"('{c}')" for c in DOCUMENT_FEATURES)
    digest = "CAST(('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 15)) AS UBIGINT)"
    return f"""WITH {STUDY_SQL},
      placed AS (SELECT *, row_number() OVER (ORDER BY {digest}, doc_id) - 1 AS place, count(*) OVER () AS n FROM study),
      base AS (SELECT avg(CASE WHEN CAST({_PLAIN_SQL} > 0.5 AS INT) = quality THEN 1.0 ELSE 0.0 END) AS right FROM study),
      swapped AS (SELECT f.feature, s.t, r.quality, {picked}
        FROM placed r CROSS JOIN (VALUES {steps}) s(t, a) CROSS JOIN (VALUES {names}) f(feature)
          JOIN placed d ON d.place = (s.a * ((r.place + s.t + 1) % r.n)) % r.n),
      drops AS (SELECT feature, t, (SELECT "right" FROM base)
          - avg(CASE WHEN CAST({_PLAIN_SQL} > 0.5 AS INT) = quality THEN 1.0 ELSE 0.0 END) AS lost
        FROM swapped GROUP BY 1, 2)
      SELECT feature, round(avg(lost), 6) AS importance, round(stddev_pop(lost), 6) AS importance_std
      FROM drops GROUP BY 1""".replace("AS right FROM", 'AS "right" FROM')


@CATALOG.query(_permuted_sql())
def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy lost by the fixed formula when a feature takes donor values."""
    scores = explain.permutation_scores(
        stored_study(spark, folder).table,
        ["doc_id"],
        DOCUMENT_FEATURES,
        "quality",
        formula,
        repeats=_REPEATS,
        seed=42,
    )
    ranked = explain.permutation_importance(scores)
    # adding 0.0 turns a rounded -0.0 into 0.0
    return ranked.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("importance", "importance_std")})


def _dependence_sql() -> str:
    grids, scored = [], []
    for c in DOCUMENT_FEATURES:
        ends = ", ".join(
            f"x[k{i}] + (x[k{i} + 1] - x[k{i}]) * greatest(0, least(1, h{i} - k{i})) AS e{i}" for i in (1, 2)
        )
        spots = ", ".join(
            f"{p} * len(x) + 0.4 + 0.2 * {p} AS h{i}, "
            f"CAST(greatest(1, least(len(x) - 1, floor({p} * len(x) + 0.4 + 0.2 * {p}))) AS BIGINT) AS k{i}"
            for i, p in ((1, 0.05), (2, 0.95))
        )
        grids.append(
            f"""SELECT DISTINCT '{c}' AS feature, {c} AS grid FROM study WHERE (SELECT count(DISTINCT {c}) FROM study) < 100
                UNION ALL SELECT '{c}', e1 + (e2 - e1) / 99 * i FROM (
                  SELECT {ends} FROM (SELECT x, {spots} FROM (SELECT list({c} ORDER BY {c}) AS x FROM study))), range(100) t(i)
                WHERE (SELECT count(DISTINCT {c}) FROM study) >= 100"""
        )
        moved = {f: (f"s.{f}" if f != c else "g.grid") for f in DOCUMENT_FEATURES}
        scored.append(
            f"""SELECT g.feature, g.grid, avg(1.0 / (1.0 + exp(-{_margin_sql(moved)}))) AS p
                FROM grids g CROSS JOIN study s WHERE g.feature = '{c}' GROUP BY 1, 2"""
        )
    return (
        f"WITH {STUDY_SQL}, grids AS ({' UNION ALL '.join(grids)}), scored AS ({' UNION ALL '.join(scored)}) "
        "SELECT feature, round(grid, 6) AS grid, round(p, 6) AS mean_probability FROM scored"
    )


@CATALOG.query(_dependence_sql())
def partial_dependence(spark: SparkSession, folder: str) -> DataFrame:
    """Mean probability of the fixed formula along each feature."""
    documents = standins.labelled_documents(spark, folder)
    stored = runtime.store(documents.select(*DOCUMENT_FEATURES), "features")
    table = explain.partial_dependence(stored, DOCUMENT_FEATURES, formula)
    return table.select("feature", F.round("grid", 6).alias("grid"), F.round("mean_probability", 6).alias("mean_probability"))


@CATALOG.query()
def balanced_logit(spark: SparkSession, folder: str) -> DataFrame:
    """Report of the balanced logistic regression on the test side."""
    study = stored_study(spark, folder)
    train, test = patient.scaled_sides(study)
    return patient.report(study, patient.fit_balanced_logit(train, study.features, study.label).apply(test))


@CATALOG.query()
def forest_report(spark: SparkSession, folder: str) -> DataFrame:
    """Report of the plain forest on the test side."""
    study = stored_study(spark, folder)
    train, test = study.sides()
    return patient.report(study, patient.fit_forest(train, study).apply(test))


@CATALOG.query()
def balanced_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Report of the balanced forest on the test side."""
    study = stored_study(spark, folder)
    train, test = study.sides()
    return patient.report(study, patient.fit_forest(train, study, balance=True).apply(test))


@CATALOG.query()
def balanced_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy, recall and precision of the balanced tree on the test side."""
    study = stored_study(spark, folder)
    train, test = study.sides()
    scored = patient.fit_balanced_tree(train, study).apply(test)
    scores = metrics.binary_scores(metrics.binary_counts(scored, study.label, "prediction"))
    return scores.unpivot([], ["accuracy", "recall", "precision"], "metric", "value")


@CATALOG.query()
def cv_report(spark: SparkSession, folder: str) -> DataFrame:
    """Mean scores over five stratified folds."""
    return patient.cross_validation(stored_study(spark, folder))


@CATALOG.query()
def cv_report_scaled_before(spark: SparkSession, folder: str) -> DataFrame:
    """The same with features standardised once over all rows."""
    return patient.cross_validation(stored_study(spark, folder), scale_before=True)


@CATALOG.query()
def coef_table(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficients of the balanced logistic regression."""
    study = stored_study(spark, folder)
    train, _ = patient.scaled_sides(study)
    return explain.coefficient_table(train, patient.fit_balanced_logit(train, study.features, study.label))


@CATALOG.query()
def mdi_table(spark: SparkSession, folder: str) -> DataFrame:
    """Impurity importances of a forest on scaled features."""
    study = stored_study(spark, folder)
    train, _ = patient.scaled_sides(study)
    return explain.impurity_importance(train, patient.fit_forest(train, study))


@CATALOG.query()
def permutation_importance_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy a forest loses on its train rows when a feature takes donor values, 30 repeats."""
    study = stored_study(spark, folder)
    train, _ = patient.scaled_sides(study)
    return patient.permutation_table(study, train, patient.fit_forest(train, study))


@CATALOG.query()
def partial_dependence_logit(spark: SparkSession, folder: str) -> DataFrame:
    """Mean probability of the balanced logistic regression along each feature."""
    study = stored_study(spark, folder)
    train, _ = patient.scaled_sides(study)
    return patient.dependence_table(study, train, patient.fit_balanced_logit(train, study.features, study.label))

"""Scores of predictions, as DataFrames.

A row without a prediction counts as a wrong one everywhere. A score that is missing, and a label or
a prediction that is no known class where the classes are fixed, is an error.

Everything here first shrinks the predictions to counts (per group, per pair of classes or
per distinct score) with map-side combining; later steps work on the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import numeric
from tabloom.operators import rank


def _hit(label: str, prediction: str) -> Column:
    return F.when(F.col(label) == F.col(prediction), 1).otherwise(0)


def accuracy_by(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    prediction: str,
    *,
    digits: int | None = 2,
    out: str = "accuracy",
) -> DataFrame:
    """Percentage of right predictions per group."""
    share = F.sum(_hit(label, prediction)) / F.count("*")
    return df.groupBy(*keys).agg(numeric.percent(share, digits).alias(out))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of right predictions, as one row."""
    return df.agg(F.avg(_hit(label, prediction).cast("double")).alias("accuracy"))


def class_pairs(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Count ``n`` of each (label, prediction) pair that occurs."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence[object], *, count: str | None = None
) -> DataFrame:
    """One row per label present, one count column ``predicted_<class>`` per class, and ``predicted_other``.

    The last column holds predictions outside of ``classes`` and missing ones, so a row's cells
    add up to its label. ``count`` names a column that says how many rows a row stands for.
    """
    number = F.col(count) if count else F.lit(1).cast("long")
    cell = lambda met: F.sum(F.when(met, number).otherwise(F.lit(0).cast("long")))
    cells = [cell(F.col(prediction) == F.lit(c)).alias(f"predicted_{c}") for c in classes]
    listed = F.coalesce(F.col(prediction).isin(list(classes)), F.lit(False))
    cells.append(cell(~listed).alias("predicted_other"))
    return df.groupBy(F.col(label).alias("label")).agg(*cells)


def weighted_precision(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision per class averaged by class size, as one row; a class never predicted scores 0."""
    pairs = class_pairs(df, label, prediction).select(F.col("label").cast("double"), F.col("prediction").cast("double"), "n")
    # each pair counts once for the class it belongs to and once for the class it was given
    long = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("long").alias("given"),
                    F.lit(0).cast("long").alias("right"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("n").alias("given"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("right"),
                ),
            )
        ).alias("part")
    ).select("part.*")
    per_class = long.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "given", "right")])
    precision = numeric.ratio(F.col("right"), F.col("given"), 0.0)
    return per_class.agg(
        numeric.ratio(F.sum(precision * F.col("actual")), F.sum("actual")).alias("weighted_precision")
    )


def _zero_or_one(value: Column, what: str, *, missing: bool = False) -> Column:
    """The value as 0 or 1; anything else is an error, a missing value too unless ``missing``."""
    fine = value.isin(0, 1)
    if missing:
        fine = fine | value.isNull()
    shown = F.coalesce(value.cast("string"), F.lit("missing"))
    wrong = F.raise_error(F.concat(F.lit(f"{what} is neither 0 nor 1: "), shown)).cast("int")
    return F.when(fine, value.cast("int")).otherwise(wrong)


def binary_counts(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """The four cells of a 0/1 confusion matrix, optionally per group, in one pass.

    A missing prediction fills the cell of the wrong class (``fn`` or ``fp``).
    """
    y = _zero_or_one(F.col(label), f"label {label}")
    p = F.coalesce(_zero_or_one(F.col(prediction), f"prediction {prediction}", missing=True), 1 - y)
    cells = {"tp": (1, 1), "fp": (0, 1), "tn": (0, 0), "fn": (1, 0)}
    counted = [F.count_if((y == a) & (p == b)).alias(name) for name, (a, b) in cells.items()]
    return df.groupBy(*keys).agg(*counted) if keys else df.agg(*counted)


# Metric names of the reports.
BINARY_METRICS = ("accuracy", "balanced_accuracy", "recall", "precision")


def binary_scores(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Columns accuracy, balanced_accuracy, recall and precision from the four cells.

    A zero denominator gives 0; balanced accuracy averages over the classes that occur.
    """
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    recall, specificity = numeric.ratio(tp, tp + fn), numeric.ratio(tn, tn + fp)
    return counts.select(
        *keys,
        numeric.ratio(tp + tn, tp + tn + fp + fn, 0.0).alias("accuracy"),
        F.coalesce((recall + specificity) / 2, recall, specificity).alias("balanced_accuracy"),
        F.coalesce(recall, F.lit(0.0)).alias("recall"),
        numeric.ratio(tp, tp + fp, 0.0).alias("precision"),
    )


def _cumulative(df: DataFrame, label: str, score: str, *, corners: bool = False) -> DataFrame:
    """Score counts with running true and false positives from the highest score down.

    With ``corners`` also ``is_corner``: the first and the last score, and those after which the counts change.
    """
    number = F.col(score).cast("double")
    lost = number.isNull() | F.isnan(number)
    checked = F.when(lost, F.raise_error(F.lit(f"score {score} is missing")).cast("double")).otherwise(number)
    y = _zero_or_one(F.col(label), f"label {label}").alias("y")
    marked = rank.value_bucketed(df.select(y, checked.alias("s")), "s", "bucket", descending=True)
    y = F.col("y")
    # the bucket is a function of the score, so grouping by both gives one row per score
    counts = marked.groupBy("bucket", F.col("s").alias("threshold")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    order = [F.desc("threshold")]
    if corners:
        # a NULL next value belongs to the last score; the first one has counted nothing before itself
        counts = rank.next_values(counts, ["pos", "neg"], bucket="bucket", order=order, first=-F.col("threshold"))
    summed = rank.running_sums(counts, {"pos": "tp", "neg": "fp"}, bucket="bucket", order=order, totals=True)
    if not corners:
        return summed
    same = (F.col("pos") == F.col("pos__next")) & (F.col("neg") == F.col("neg__next"))
    is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    return summed.withColumn("is_corner", is_first | ~F.coalesce(same, F.lit(False))).drop("pos__next", "neg__next")


def roc_points(df: DataFrame, label: str, score: str, *, corners: bool = False) -> DataFrame:
    """ROC curve: one point per distinct score, and (0, 0) at threshold infinity.

    Every row needs a score; remove or fill missing ones first. With ``corners``, points inside a straight piece of
    equal steps are left out: those whose score has as many positives and negatives as the next one.
    """
    found = _cumulative(df, label, score, corners=corners)
    points = (found.filter("is_corner") if corners else found).select(
        "threshold",
        numeric.ratio(F.col("fp"), F.col("fp_total"), 0.0).alias("fpr"),
        numeric.ratio(F.col("tp"), F.col("tp_total"), 0.0).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule, as one row.

    The trapezoid above the negatives of one score has the mean of the true positives
    before and after it as height, so no neighbouring row is needed.
    """
    strip = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    whole = F.max("tp_total").cast("double") * F.max("fp_total")
    return _cumulative(df, label, score).agg(numeric.ratio(F.sum(strip), whole).alias("auc"))


def classification_report(df: DataFrame, label: str, prediction: str, probability: str) -> DataFrame:
    """Rows (metric, value): accuracy, balanced accuracy, recall, precision and AUC.

    Computed at once, because scoring is costly and three passes over its result are needed.
    """
    scored = df.select(label, prediction, probability).persist()
    try:
        scores = binary_scores(binary_counts(scored, label, prediction))
        rows = scores.unpivot([], list(BINARY_METRICS), "metric", "value").toArrow()
        area = auc(scored, label, probability).unpivot([], ["auc"], "metric", "value").toArrow()
    finally:
        scored.unpersist()
    return df.sparkSession.createDataFrame(pa.concat_tables([rows, area]))


def mean_over(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric column, as rows (metric, mean)."""
    return df.agg(*[F.avg(m).alias(m) for m in metrics]).unpivot([], list(metrics), "metric", "mean")


def mean_and_spread(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and population deviation over repeats."""
    return df.groupBy(*keys).agg(
        F.avg(value).alias(f"{value}_mean"), F.stddev_pop(value).alias(f"{value}_std")
    )


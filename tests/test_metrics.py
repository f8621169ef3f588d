import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabloom.operators import metrics, rank


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    # a third of all rows share one score
    rows = []
    for i in range(1500):
        score = 0.3 if i % 3 == 0 else round(rng.random(), 3)
        rows.append((int(rng.random() < 0.3 + 0.4 * score), score, float(score > 0.5), i % 4, float(rng.randrange(4))))
    return spark.createDataFrame(rows, "y int, s double, p double, c int, q double").repartition(6)


def test_auc_equals_the_evaluator(scored):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert metrics.auc(scored, "y", "s").first()[0] == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


def test_roc_runs_from_corner_to_corner(scored):
    points = metrics.roc_points(scored, "y", "s").orderBy(F.desc("threshold")).collect()
    assert (points[0]["fpr"], points[0]["tpr"]) == (0.0, 0.0)
    assert (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    assert len(points) == scored.select("s").distinct().count() + 1
    for a, b in zip(points, points[1:]):
        assert a["fpr"] <= b["fpr"] and a["tpr"] <= b["tpr"]


def test_weighted_precision_equals_the_evaluator(scored):
    evaluator = MulticlassClassificationEvaluator(labelCol="c", predictionCol="q", metricName="weightedPrecision")
    expected = evaluator.evaluate(scored.withColumn("c", F.col("c").cast("double")))
    assert metrics.weighted_precision(scored, "c", "q").first()[0] == pytest.approx(expected, abs=1e-12)


def test_class_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0), (1, 2.0)], "y int, p double")
    # precision: class 0 1/2, class 1 0; the predicted class 2 has no rows
    assert metrics.weighted_precision(df, "y", "p").first()[0] == pytest.approx((0.5 * 1 + 0 * 2) / 3)


def test_report(spark, scored):
    values = {r["metric"]: r["value"] for r in metrics.classification_report(scored, "y", "p", "s").collect()}
    rows = scored.collect()
    tp = sum(r["y"] == 1 and r["p"] == 1 for r in rows)
    fp = sum(r["y"] == 0 and r["p"] == 1 for r in rows)
    fn = sum(r["y"] == 1 and r["p"] == 0 for r in rows)
    tn = len(rows) - tp - fp - fn
    assert values["accuracy"] == pytest.approx((tp + tn) / len(rows))
    assert values["recall"] == pytest.approx(tp / (tp + fn))
    assert values["precision"] == pytest.approx(tp / (tp + fp))
    assert values["balanced_accuracy"] == pytest.approx((tp / (tp + fn) + tn / (tn + fp)) / 2)
    assert set(values) == {"accuracy", "balanced_accuracy", "recall", "precision", "auc"}
    nothing = spark.createDataFrame([(1, 0.0), (1, 0.0)], "y int, p double")
    score = metrics.binary_scores(metrics.binary_counts(nothing, "y", "p")).first()
    assert (score["recall"], score["precision"], score["balanced_accuracy"]) == (0.0, 0.0, 0.0)


def test_confusion_has_all_classes(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0), (1, 7.0), (1, None)], "y int, p double")
    table = metrics.confusion_matrix(df, "y", "p", (0, 1)).orderBy("label").collect()
    assert [tuple(r) for r in table] == [(0, 1, 0, 0), (1, 1, 0, 2)]


def test_missing_predictions_are_wrong_everywhere(spark):
    df = spark.createDataFrame([(0, 0.0), (1, None), (0, None)], "y int, p double")
    counts = metrics.binary_counts(df, "y", "p")
    assert tuple(counts.first()) == (0, 1, 1, 1)
    assert metrics.binary_scores(counts).first()["accuracy"] == metrics.accuracy(df, "y", "p").first()[0]


@pytest.mark.parametrize("row", [(1, 7.0, 0.5), (None, 1.0, 0.5), (2, 1.0, 0.5)])
def test_values_off_the_classes_are_errors(spark, row):
    df = spark.createDataFrame([(0, 0.0, 0.1), row], "y int, p double, s double")
    with pytest.raises(Exception, match="neither 0 nor 1"):
        metrics.binary_counts(df, "y", "p").collect()


@pytest.mark.parametrize("score", [None, float("nan")])
def test_missing_scores_are_errors(spark, score):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), (0, score)], "y int, s double")
    with pytest.raises(Exception, match="is missing"):
        metrics.auc(df, "y", "s").collect()


def test_mean_and_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, v double")
    assert tuple(metrics.mean_and_spread(df, ["k"], "v").first()) == ("a", 2.0, 1.0)


def test_corners_of_the_curve(spark, scored, monkeypatch):
    """Points stay unless their score has the counts of the next one, whatever the buckets."""
    counts = scored.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).orderBy(F.desc("s")).collect()
    steps = [(r["pos"], r["neg"]) for r in counts]
    kept = {r["s"] for i, r in enumerate(counts) if i in (0, len(steps) - 1) or steps[i] != steps[i + 1]}
    for bits in (4, 6, 10):
        monkeypatch.setattr(rank, "bucket_bits", lambda _, bits=bits: bits)
        points = metrics.roc_points(scored, "y", "s", corners=True).collect()
        assert {r["threshold"] for r in points} == kept | {float("inf")}
        whole = {tuple(r) for r in metrics.roc_points(scored, "y", "s").collect()}
        assert {tuple(r) for r in points} <= whole and len(points) < len(whole)
    one = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert metrics.roc_points(one, "y", "s", corners=True).count() == 2


def test_confusion_matrix_of_counted_rows(spark):
    df = spark.createDataFrame([(0, 0.0, 3), (0, 1.0, 2), (1, None, 4), (1, 1.0, 0), (None, 1.0, 5)], "y int, p double, n long")
    told = {tuple(r) for r in metrics.confusion_matrix(df, "y", "p", (0, 1), count="n").collect()}
    assert told == {(0, 3, 2, 0), (1, 0, 0, 4), (None, 0, 5, 0)}
    assert {tuple(r) for r in metrics.confusion_matrix(df, "y", "p", (0, 1)).collect()} == {(0, 1, 1, 0), (1, 0, 1, 1), (None, 0, 1, 0)}

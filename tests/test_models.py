import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import crossval, explain, models
from tabloom.plans.patient import Study


@pytest.fixture(scope="module")
def labelled(spark):
    x = (F.pmod(F.hash("id", F.lit(1)), F.lit(1000)) / 500.0 - 1).alias("x")
    z = (F.pmod(F.hash("id", F.lit(2)), F.lit(1000)) / 500.0 - 1).alias("z")
    noise = F.pmod(F.hash("id", F.lit(3)), F.lit(1000)) / 1000.0
    df = spark.range(600).select("id", x, z)
    return df.withColumn("y", ((F.col("x") * 2 + noise) > 1.2).cast("int")).persist()


def test_balanced_logit_is_optimal(labelled):
    data = models.balanced(labelled, "y")
    fitted = models.fit_logit(data, ["x", "z"], "y", weight="weight", inverse_penalty=1.0, tolerance=1e-12, iterations=300)
    rows = data.collect()
    x = np.array([[r["x"], r["z"]] for r in rows])
    y, w = np.array([r["y"] for r in rows]), np.array([r["weight"] for r in rows])
    beta, b = fitted.model.coefficients.toArray(), fitted.model.intercept
    p = 1 / (1 + np.exp(-(x @ beta + b)))
    # gradient of 1/2 |beta|^2 + sum of weighted losses
    assert np.abs(beta + x.T @ (w * (p - y))).max() < 1e-3
    assert abs((w * (p - y)).sum()) < 1e-3


def test_prediction_follows_the_probability(labelled):
    scored = models.fit_logit(labelled, ["x", "z"], "y").apply(labelled)
    assert scored.filter((F.col("p1") > 0.5) != (F.col("prediction") == 1.0)).count() == 0
    assert set(scored.columns) == {"id", "x", "z", "y", "prediction", "p1"}


def test_trees_do_not_depend_on_the_input_layout(labelled):
    found = []
    for df in (labelled, labelled.repartition(7), labelled.orderBy(F.desc("x")).repartition(3, "z")):
        fitted = models.fit_forest(models.fixed_layout(df, ["id"], 60), ["x", "z"], "y", trees=10, subset="sqrt")
        found.append(fitted.model.featureImportances.toArray().tolist())
    assert found[0] == found[1] == found[2]


def test_layout_follows_the_rows(spark, labelled):
    counts = [models.fixed_layout(labelled, ["id"], n).rdd.getNumPartitions() for n in (10**9, 60, 30)]
    rows = labelled.count()
    assert counts == [1, -(-rows // 60), -(-rows // 30)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert models.fixed_layout(labelled, ["id"], 30).rdd.getNumPartitions() == counts[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_importance_tables(labelled):
    tree = models.fit_tree(models.balanced(labelled, "y"), ["x", "z"], "y", weight="weight")
    table = explain.impurity_importance(labelled, tree).collect()
    assert table[0]["feature"] == "x" and sum(r["importance"] for r in table) == pytest.approx(1.0)
    logit = models.fit_logit(labelled, ["z", "x"], "y")
    assert explain.coefficient_table(labelled, logit).first()["feature"] == "x"


def test_cross_validation(labelled):
    for before in (False, True):
        table = crossval.cross_validate(
            labelled, ["id"], ["x", "z"], "y", lambda d: models.fit_logit(d, ["x", "z"], "y"), folds=3, scale_before=before
        )
        values = {r["metric"]: r["mean"] for r in table.collect()}
        assert set(values) == {"accuracy", "balanced_accuracy", "recall", "precision"}
        assert 0.6 < values["accuracy"] <= 1.0


def test_every_row_is_scored_once_across_folds(labelled):
    from tabloom.operators import split

    placed = split.stratified_folds(labelled, ["id"], "y", 3, 1)
    scored = crossval.fold_predictions(placed, ["x", "z"], "y", 3, lambda d: models.fit_logit(d, ["x", "z"], "y"))
    assert scored.count() == 600 and scored.select("id").distinct().count() == 600


@pytest.mark.parametrize("rows", [1, 2, 600, 100_003])
def test_donors_are_permutations(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("place"), F.col("id").alias("x"))
    donated = explain.with_donors(df, "place", rows, range(3), ["x"])
    per = donated.groupBy("repeat").agg(F.count("*").alias("n"), F.countDistinct("donor_x").alias("d")).collect()
    assert {(r["n"], r["d"]) for r in per} == {(rows, rows)} and len(per) == 3


def test_permutation_importance(labelled):
    def score(df):
        return df.withColumn("prediction", F.when(F.col("x") > 0.3, 1.0).otherwise(0.0))

    scores = explain.permutation_scores(labelled, ["id"], ["x", "z"], "y", score, repeats=7, per_job=3)
    assert scores.count() == 14
    table = {r["feature"]: r for r in explain.permutation_importance(scores).collect()}
    assert table["z"]["importance"] == 0.0 and table["z"]["importance_std"] == 0.0
    assert table["x"]["importance"] > 0.1


def test_partial_dependence_equals_brute_force(labelled):
    def score(df):
        return df.withColumn("p1", F.col("x") * 2 + F.col("z"))

    data = labelled.withColumn("z", F.round("z", 1))
    table = explain.partial_dependence(data, ["x", "z"], score, points=30).collect()
    rows = data.collect()
    x, z = np.array([r["x"] for r in rows]), np.array([r["z"] for r in rows])
    got = {f: sorted((r["grid"], r["mean_probability"]) for r in table if r["feature"] == f) for f in ("x", "z")}
    assert len(got["x"]) == 30 and [g for g, _ in got["z"]] == sorted(set(z))
    assert [p for _, p in got["x"]] == pytest.approx([2 * g + z.mean() for g, _ in got["x"]])
    assert [p for _, p in got["z"]] == pytest.approx([2 * x.mean() + g for g, _ in got["z"]])


def test_study_sides_are_stored_and_disjoint(labelled):
    train, test = Study(labelled, ("id",), ("x", "z"), "y").sides()
    assert train.count() == 420 and test.count() == 180
    assert train.join(test, "id").count() == 0

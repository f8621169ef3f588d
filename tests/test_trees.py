import pytest
from pyspark.sql import functions as F

from tabloom.operators import models, trees


@pytest.fixture(scope="module")
def labelled(spark):
    draw = lambda seed, n: F.pmod(F.hash("id", F.lit(seed)), F.lit(n))
    df = spark.range(900).select("id", (draw(1, 1000) / 500.0 - 1).alias("x"), (draw(2, 40) / 20.0).alias("z"), draw(4, 3).cast("double").alias("u"))
    noise = draw(3, 1000) / 700.0
    kind = F.when(F.col("x") * 2 + noise > 1.4, 2).when(F.col("z") + noise > 1.6, 1).otherwise(0)
    return df.withColumn("kind", kind).withColumn("y", (F.col("kind") == 2).cast("int")).persist()


FEATURES = ("x", "z", "u")


def forest(spark, df, label, **options):
    return models.fit_forest(models.fixed_layout(df, ["id"], 300), FEATURES, label, trees=12, subset="sqrt", **options)


@pytest.mark.parametrize("label", ["y", "kind"])
def test_the_table_predicts_what_the_model_does(spark, labelled, label):
    for fitted in (forest(spark, labelled, label), models.fit_tree(labelled, FEATURES, label)):
        nodes = trees.read_nodes(spark, fitted)
        theirs = fitted.apply(labelled).select("id", F.col("prediction").alias("p"), F.col("p1").alias("q"))
        both = nodes.apply(labelled).join(theirs, "id")
        assert both.count() == 900
        assert both.filter((F.col("prediction") != F.col("p")) | (F.abs(F.col("p1") - F.col("q")) > 1e-12)).count() == 0


def test_importance_is_that_of_the_model(spark, labelled):
    weighted = models.balanced(labelled, "kind")
    for fitted in (forest(spark, weighted, "kind", weight="weight"), models.fit_tree(labelled, FEATURES, "y")):
        rows = trees.importance(spark, trees.read_nodes(spark, fitted)).collect()
        expected = dict(zip(FEATURES, fitted.model.featureImportances.toArray(), strict=True))
        assert {r["feature"]: r["importance"] for r in rows} == pytest.approx(expected)


def test_counts_are_those_of_a_walk_through_the_table(spark, labelled):
    nodes = trees.with_rows(trees.read_nodes(spark, forest(spark, labelled, "kind")), labelled)
    rows = labelled.collect()
    for tree in nodes.trees:
        passed = dict.fromkeys(tree, 0)
        for row in rows:
            at = 0
            passed[0] += 1
            while tree[at]["low"] is not None:
                at = tree[at]["low"] if row[tree[at]["feature"]] <= tree[at]["threshold"] else tree[at]["high"]
                passed[at] += 1
        assert {n: node["rows"] for n, node in tree.items()} == passed


def test_a_minimum_split_size(spark, labelled):
    whole = trees.with_rows(trees.read_nodes(spark, forest(spark, labelled, "y", depth=8)), labelled)
    cut = trees.collapsed(whole, 120)
    assert sum(map(len, cut.trees)) < sum(map(len, whole.trees))
    for tree in cut.trees:
        for node in tree.values():
            assert (node["low"] is None) == (node["high"] is None) == (node["feature"] is None)
            assert node["low"] is None or node["rows"] >= 120
            assert node["parent"] is None or tree[node["parent"]]["low"] is not None
    # predictions by hand, from the nodes that are left
    row = labelled.orderBy("id").first()
    votes = [0.0, 0.0]
    for tree in cut.trees:
        at = 0
        while tree[at]["low"] is not None:
            at = tree[at]["low"] if row[tree[at]["feature"]] <= tree[at]["threshold"] else tree[at]["high"]
        votes = [v + w / sum(tree[at]["weights"]) for v, w in zip(votes, tree[at]["weights"])]
    told = cut.apply(labelled).orderBy("id").first()
    assert told["p1"] == pytest.approx(votes[1] / sum(votes)) and told["prediction"] == float(votes[1] > votes[0])
    assert trees.collapsed(whole, 0).trees == whole.trees
    assert all(len(t) == 1 for t in trees.collapsed(whole, 10**6).trees)


def test_each_feature_vector_is_routed_once(spark, labelled, monkeypatch):
    fitted = models.fit_forest(models.fixed_layout(labelled, ["id"], 300), ("u",), "y", trees=5)
    routed, seen = trees._routed, []
    monkeypatch.setattr(trees, "_routed", lambda forest, df: seen.append(df.count()) or routed(forest, df))
    nodes = trees.with_rows(trees.read_nodes(spark, fitted), labelled)
    assert seen == [3]  # u has three values
    assert all(tree[0]["rows"] == 900 for tree in nodes.trees)


@pytest.mark.parametrize("label", ["y", "kind"])
def test_a_cut_forest_scores_with_spark_own_model(spark, labelled, label):
    for fitted in (forest(spark, labelled, label, depth=8), models.fit_tree(labelled, FEATURES, label, depth=8)):
        cut = trees.collapsed(trees.with_rows(trees.read_nodes(spark, fitted), labelled), 60)
        told = cut.apply(labelled)
        assert "lambda" not in told._jdf.queryExecution().optimizedPlan().toString()
        again = trees.read_nodes(spark, cut.pruned)
        paths = lambda found: [sorted((n["path"], n["feature"], n["threshold"]) for n in t.values()) for t in found]
        assert paths(again.trees) == paths(cut.trees) != paths(cut.grown)
        for row in told.limit(200).collect():
            votes = [0.0] * len(cut.trees[0][0]["weights"])
            for tree in cut.trees:
                at = 0
                while tree[at]["low"] is not None:
                    at = tree[at]["low"] if row[tree[at]["feature"]] <= tree[at]["threshold"] else tree[at]["high"]
                votes = [v + w / sum(tree[at]["weights"]) for v, w in zip(votes, tree[at]["weights"], strict=True)]
            assert row["prediction"] == votes.index(max(votes)) and row["p1"] == pytest.approx(votes[1] / sum(votes))


def test_a_missing_feature_is_an_error(spark, labelled):
    nodes = trees.read_nodes(spark, models.fit_tree(labelled, FEATURES, "y"))
    broken = labelled.withColumn("x", F.when(F.col("id") != 5, F.col("x")))
    with pytest.raises(Exception, match="null"):
        nodes.apply(broken).collect()


def test_score_equations_tell_an_optimum_from_another_point(spark, labelled):
    weighted = models.balanced(labelled, "y")
    gap = F.max(F.abs(F.col("fitted") - F.col("observed")))
    for options in ({"weight": "weight", "inverse_penalty": 0.5}, {}):
        best = models.fit_logit(weighted, FEATURES, "y", iterations=300, tolerance=1e-12, **options)
        assert models.score_equations(weighted, best, "y", **options).agg(gap).first()[0] < 1e-6
        early = models.fit_logit(weighted, FEATURES, "y", iterations=1, **options)
        assert models.score_equations(weighted, early, "y", **options).agg(gap).first()[0] > 1e-3

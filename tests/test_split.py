import math

import pytest
from pyspark.sql import functions as F

from tabloom.operators import classes, split


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).select("id", (F.col("id") % 10 < 3).cast("int").alias("y"))


def sides(df, *keys):
    return {tuple(r[k] for k in keys): r["split"] for r in df.collect()}


def test_hash_split(rows):
    parts = sides(split.hash_split(rows, ["id"], {"train": 0.8, "test": 0.2}, 5), "id")
    assert 740 < sum(s == "train" for s in parts.values()) < 860
    assert parts == sides(split.hash_split(rows.repartition(7), ["id"], {"train": 0.8, "test": 0.2}, 5), "id")
    three = split.hash_split(rows, ["id"], {"a": 1, "b": 1, "c": 2}, 5).groupBy("split").count().collect()
    assert {r["split"] for r in three} == {"a", "b", "c"}


def test_group_rows_stay_together(rows):
    parts = split.hash_split(rows.withColumn("g", F.col("id") % 40), ["g"], {"train": 0.8, "test": 0.2}, 5)
    assert parts.groupBy("g").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


@pytest.mark.parametrize("fraction", [0.8, 0.777, 0.0, 1.0])
def test_exact_split(rows, fraction):
    parts = sides(split.exact_split(rows, ["id"], fraction, 5), "id")
    assert sum(s == "train" for s in parts.values()) == int(fraction * 1000)
    assert parts == sides(split.exact_split(rows.repartition(3), ["id"], fraction, 5), "id")


def test_patient_sized_stratified_split(spark):
    df = spark.range(768).select("id", (F.col("id") < 268).cast("int").alias("y"))
    counts = {(r["split"], r["y"]): r["count"] for r in split.stratified_split(df, ["id"], "y", 0.3, 42).groupBy("split", "y").count().collect()}
    assert counts["test", 0] + counts["test", 1] == math.ceil(0.3 * 768) == 231
    assert abs(counts["test", 1] - 231 * 268 / 768) < 1


def test_many_classes_beyond_the_limits(spark, small_limits):
    df = spark.range(900).select("id", (F.pmod(F.col("id") * F.col("id"), F.lit(83))).alias("y"))
    parts = split.stratified_split(df, ["id"], "y", 0.3, 42)
    per = parts.groupBy("y").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()
    assert sum(r["t"] for r in per) == 270 and sum(r["n"] for r in per) == 900
    assert all(abs(r["t"] - 0.3 * r["n"]) <= 1 for r in per)
    check_folds(split.stratified_folds(df, ["id"], "y", 5, 42), 900, 5)


def check_folds(df, rows, folds):
    sizes = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert sorted(sizes) == list(range(folds)) and sum(sizes.values()) == rows
    assert max(sizes.values()) - min(sizes.values()) <= 1
    cells = df.groupBy("y").pivot("fold", list(range(folds))).count().na.fill(0).collect()
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in cells)


def test_stratified_folds(rows):
    check_folds(split.stratified_folds(rows, ["id"], "y", 5, 42), 1000, 5)
    check_folds(split.stratified_folds(rows.limit(997), ["id"], "y", 3, 42), 997, 3)


def test_missing_class_keeps_its_rows(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(60)], "id long, y int")
    assert split.stratified_split(df, ["id"], "y", 0.5, 1).count() == 60
    assert split.stratified_folds(df, ["id"], "y", 4, 1).filter("fold is null").count() == 0


def test_class_weights_sum_to_the_rows(rows):
    weighted = classes.with_class_weight(rows, "y").groupBy("y").agg(F.sum("weight").alias("w")).collect()
    assert [r["w"] for r in weighted] == pytest.approx([500.0, 500.0])


def test_many_classes_are_handled_as_few_are(spark, monkeypatch):
    """Tables made by Spark and by the driver agree; 20,000 classes, one of them missing and one with a third of the rows."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") == 7, F.lit(None)).otherwise(F.concat(F.lit("c"), (F.col("id") % 19_998).cast("string")))
    df = spark.range(60_000).select("id", hot.alias("y"))
    found = {}
    for limit in (10, 100_000):
        monkeypatch.setattr(classes, "MAX_CLASSES", limit)
        found[limit] = [
            sorted(map(str, table.collect()))
            for table in (
                split.stratified_split(df, ["id"], "y", 0.3, 42),
                split.stratified_folds(df, ["id"], "y", 5, 42),
                classes.class_weights(df, "y").select("y", "n", "weight"),
                classes.with_class_weight(df, "y"),
            )
        ]
    assert found[10] == found[100_000]

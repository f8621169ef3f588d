import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import classes, lookup, rank


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows."""
    return spark.range(2000).select("id", F.when(F.col("id") % 7 > 0, "hot").otherwise("cold").alias("g")).repartition(5)


def test_hash_rank_is_a_permutation_for_any_layout(spark, skewed):
    ranks = {r["id"]: r["p"] for r in rank.hash_rank(skewed, "p", ["id"], 3, total="n").collect()}
    assert sorted(ranks.values()) == list(range(1, 2001))
    again = {r["id"]: r["p"] for r in rank.hash_rank(skewed.repartition(3, "g"), "p", ["id"], 3).collect()}
    assert ranks == again
    assert ranks != {r["id"]: r["p"] for r in rank.hash_rank(skewed, "p", ["id"], 4).collect()}


def test_hash_rank_within_groups(skewed):
    rows = rank.hash_rank(skewed, "p", ["id"], 3, within=["g"], total="n").collect()
    for group in ("hot", "cold"):
        part = [r for r in rows if r["g"] == group]
        assert sorted(r["p"] for r in part) == list(range(1, len(part) + 1))
        assert {r["n"] for r in part} == {len(part)}


def test_rank_keeps_missing_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, g string")
    rows = rank.hash_rank(df, "p", ["id"], 1, within=["g"]).collect()
    assert sorted(r["p"] for r in rows if r["g"] is None) == [1, 2] and len(rows) == 3


def test_ordered_rank_of_a_large_table(spark, small_limits):
    words = [f"w{i:04d}" for i in range(500)]
    random.Random(1).shuffle(words)
    df = spark.createDataFrame([(w, i % 3) for i, w in enumerate(words)], ["w", "k"]).repartition(6)
    got = [r["w"] for r in rank.ordered_rank(df, "p", [F.desc("k"), F.asc("w")]).orderBy("p").collect()]
    assert got == [w for _, w in sorted((-(i % 3), w) for i, w in enumerate(words))]
    sums = rank.ordered_sum(df, "k", "s", ["w"]).orderBy("w").collect()
    total, expected = 0, []
    for r in sums:
        total += r["k"]
        expected.append(total)
    assert [r["s"] for r in sums] == expected


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_follow_the_values(spark, descending):
    values = [random.Random(i).choice([0.5, 0.25, random.Random(i).random()]) for i in range(400)]
    df = spark.createDataFrame([(v,) for v in sorted(set(values))], ["v"]).withColumn("n", F.lit(2)).repartition(4)
    marked = rank.value_bucketed(df, "v", "b", descending=descending)
    order = F.desc("v") if descending else F.asc("v")
    rows = rank.running_sums(marked, {"n": "s"}, bucket="b", order=[order], totals=True).orderBy(order).collect()
    assert [r["s"] for r in rows] == [2 * (i + 1) for i in range(len(rows))]
    assert {r["s_total"] for r in rows} == {2 * len(rows)}


def test_lookup_join_beyond_the_broadcast_limit(spark, small_limits):
    # hot known and unknown values, a hot missing value, and a long tail of rare ones
    values = ["the"] * 300 + ["unknown"] * 200 + [None] * 250 + [f"t{i}" for i in range(100)] * 2
    df = spark.createDataFrame(list(enumerate(values)), "id long, w string").repartition(4)
    table = spark.createDataFrame([("the", 1)] + [(f"t{i}", i + 10) for i in range(100)], "w string, no long")
    got = {r["id"]: r["no"] for r in lookup.lookup_join(df, "w", table, "w").collect()}
    names = {r["w"]: r["no"] for r in table.collect()}
    assert got == {i: names.get(v) for i, v in enumerate(values)}


def test_lookup_join_without_frequent_values(spark, small_limits):
    df = spark.createDataFrame([(i, f"t{i % 60}") for i in range(120)], "id long, w string")
    table = spark.createDataFrame([(f"t{i}", i) for i in range(50)], "w string, no long")
    got = {r["id"]: r["no"] for r in lookup.lookup_join(df, "w", table, "w").collect()}
    assert got == {i: (i % 60 if i % 60 < 50 else None) for i in range(120)}


@pytest.mark.parametrize("limit", [None, 3])
def test_frequent_entries_fit_the_limit(spark, monkeypatch, limit):
    from tabloom import runtime

    if limit:
        monkeypatch.setattr(runtime, "BROADCAST_ROWS", limit)
    df = spark.createDataFrame([("a", 1000), ("b", 600), ("c", 3), ("d", 2), ("e", 2)], "w string, n long")
    floor = lookup.frequent_floor(df, "n")
    kept = df.filter(F.floor(F.log2("n")) >= floor).count()
    assert kept == (5 if limit is None else 2)


def test_category_index_by_frequency_then_name(spark, small_limits):
    df = spark.createDataFrame([(c,) for c in "bbaac"] + [(None,)], "v string")
    rows = classes.category_index(df, "v").collect()
    assert {r["v"]: r["label"] for r in rows} == {"a": 0, "b": 1, "c": 2}


def test_index_names(spark):
    df = spark.createDataFrame([(c,) for c in "bbaac"], ["v"])
    index = classes.category_index(df, "v")
    scored = spark.createDataFrame([(0.0,), (2.0,), (9.0,), (None,)], "prediction double")
    named = classes.index_names(scored, "prediction", index, "label", "v", "name").collect()
    assert {(r["prediction"], r["name"]) for r in named} == {(0.0, "a"), (2.0, "c"), (9.0, None), (None, None)}

from pyspark.sql import functions as F

from helpers import documents, prose

from tabloom.llm import mixing, text


def sizes(docs):
    return docs.withColumn("size", text.word_count(F.col("text")))


def rates(spark, rows, **kw):
    found = mixing.source_rates(sizes(documents(spark, rows)), "source", "size", **kw).collect()
    return {r["mix__source"]: (r["source_size"], r["target"], r["rate"]) for r in found}


def test_targets_follow_weights_and_stop_at_the_limit(spark):
    rows = [(1, prose(1, 600), "a"), (2, prose(2, 30), "b"), (3, prose(3, 300), None)]
    got = rates(spark, rows)
    # weights 1, 2, 3: b stops at 90; the other 840 words go 1 : 3 to a and the missing source
    assert got["b"] == (30, 90.0, 3.0)
    assert got["a"][1] == 210.0 and got[None][1] == 630.0
    assert sum(t for _, t, _ in got.values()) == 930.0


def test_excess_is_shared_again_until_no_source_is_above(spark):
    rows = [(1, prose(1, 1000), "a"), (2, prose(2, 10), "b"), (3, prose(3, 100), "c"), (4, prose(4, 1), "d")]
    got = rates(spark, rows)
    assert all(t <= 3 * n + 1e-9 for n, t, _ in got.values())
    assert abs(sum(t for _, t, _ in got.values()) - 1111) < 1e-6


def test_copies_are_repeatable_and_near_the_target(spark):
    rows = [(i, prose(i, 20 + i % 7), "ab"[i % 3 == 0]) for i in range(3000)]
    docs = documents(spark, rows, "copy", "size", "rate", "copies", "target")
    first = mixing.mix(docs, text.word_count(F.col("text")))
    assert first.columns == [c for c in docs.columns if c != "copy"] + ["copy"]
    taken = {r["source"]: r["n"] for r in first.groupBy("source").agg(F.sum(text.word_count(F.col("text"))).alias("n")).collect()}
    for source, (_, target, _) in rates(spark, rows).items():
        assert abs(taken[source] - target) < 0.1 * target
    again = mixing.mix(docs.repartition(5), text.word_count(F.col("text")))
    key = lambda df: sorted((r["doc_id"], r["copy"]) for r in df.select("doc_id", "copy").collect())
    assert key(first) == key(again)


def test_empty_missing_and_repeated_rows(spark):
    none = documents(spark, [])
    assert mixing.mix(none, text.word_count(F.col("text"))).count() == 0
    blank = documents(spark, [(1, None, "a"), (2, "", "b"), (None, None, None)])
    assert mixing.mix(blank, text.word_count(F.col("text"))).count() == 0
    twice = documents(spark, [(1, prose(1, 9), "a"), (1, prose(1, 9), "a"), (None, prose(2, 9), None)])
    copies = mixing.mix(twice, text.word_count(F.col("text"))).groupBy("doc_id", "copy").count().collect()
    assert {r["count"] for r in copies if r["doc_id"] == 1} == {2}


def test_texts_without_an_id_are_decided_one_by_one(spark):
    rows = [(None if i % 2 else 5, prose(i, 20), "ab"[i % 3 == 0]) for i in range(900)]
    taken = mixing.mix(documents(spark, rows), text.word_count(F.col("text")), body="text").groupBy("source").count().collect()
    for source, (_, target, _) in rates(spark, rows).items():
        assert abs({r["source"]: 20 * r["count"] for r in taken}[source] - target) < 0.15 * target


def test_query_reaches_targets_where_ids_are_missing_or_repeat(spark, tmp_path):
    rows = [(None if i % 2 else 5, prose(i, 20), "ab"[i % 3 == 0]) for i in range(900)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = mixing.op7_mixing(spark, str(tmp_path)).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(found) == 2 and all(abs(r["taken"] - r["target"]) < 0.15 * r["target"] for r in found)

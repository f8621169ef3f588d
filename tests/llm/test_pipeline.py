import collections

import corpus_pipeline
import pytest
from helpers import documents, near_classes, prose, words
from pyspark.sql import functions as F
from test_decontaminate import brute as leaks
from test_line_dedup import brute as lines_once

from tabloom import runtime


@pytest.fixture
def folder(spark, tmp_path):
    item = prose(1, 40)
    rows = [(i, prose(100 + i, 70) + f"\nall documents share this one line\n{prose(200 + i, 30)}", f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, prose(100, 70) + "\n" + prose(200, 29) + f" x{i}", "s0") for i in range(5)]  # near copies of 0
    rows += [(200, prose(300, 60) + "\n" + item, "s1"), (201, "too short", "s1"), (202, None, None), (203, "spam " * 90, "s2")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_every_stage_equals_brute_force_on_its_input(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality_rules"](spark, docs, folder)
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    assert good.columns == columns and set(texts) == set(range(40)) | set(range(100, 105)) | {200}

    once = stages["line_dedup"](spark, good, folder)
    want = {d: t for d, (t, _, _) in lines_once(list(texts.items())).items() if words(t)}
    assert once.columns == columns and {r["doc_id"]: r["text"] for r in once.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in once.collect())

    single = stages["near_dedup"](spark, once, folder)
    left = {r["doc_id"]: r["text"] for r in single.collect()}
    assert single.columns == columns and left == {d: want[d] for d, c in near_classes(list(want.items())).items() if c == d}

    clean = stages["decontaminate"](spark, single, folder)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    gone = {d for d, _ in leaks(list(left.items()), items)}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == set(left) - gone and 200 in gone

    mixed = stages["mixing"](spark, clean, folder).collect()
    taken = collections.Counter(r["doc_id"] for r in mixed)
    assert set(taken) <= set(left) - gone and max(taken.values()) <= 3


def test_run_gives_what_the_stages_give(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    key = lambda df: sorted((r["doc_id"], r["copy"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, folder)) == key(docs)


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_quality_stage_removes_frequent_lines(spark):
    rows = [(i, f"Menu {i} home\n{prose(i, 80)}", "h") for i in range(20)] + [(99, f"Menu 1 home\n{prose(99, 80)}", "other")]
    good = dict(corpus_pipeline.STAGES)["quality_rules"](spark, documents(spark, rows), "").collect()
    want = {i: prose(i, 80) for i in range(20)} | {99: rows[-1][1]}
    assert {r["doc_id"]: r["text"] for r in good} == want
    assert all(r["n_chars"] == len(r["text"]) for r in good)


CLASHES = (
    "host_key body_hash shape own_limits kept depleted n_words n_lines n_dropped row key size of doc node "
    "line_dedup__doc line_dedup__drop near_dedup__doc decontaminate__hit mix__source quality__limits item_id"
).split()


def test_other_columns_pass_through_whatever_their_names(spark, tmp_path):
    item = prose(1, 40)
    rows = [(i, prose(100 + i, 70), f"s{i % 3}") for i in range(12)]
    rows += [(None, prose(300 + i, 70), "s0") for i in range(6)] + [(4, prose(400 + i, 70), None) for i in range(4)]
    rows += [(5, prose(105, 70), "s2")] * 3  # repeated rows
    rows += [(30, prose(500, 60) + " " + item, "s1"), (None, prose(501, 60) + " " + item, "s1")]
    rows += [(31, prose(502, 60_000), "s2"), (32, None, "s1"), (33, "", None)]
    frame = documents(spark, rows)
    for i, name in enumerate(CLASHES):
        frame = frame.withColumn(name, F.concat(F.lit(f"{i} "), F.substring("text", 1, 20)))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = runtime.store(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == (columns if name != "mixing" else [*columns, "copy"])
        for row in docs.collect():
            assert all(row[c] == f"{i} {row['text'][:20]}" for i, c in enumerate(CLASHES))
            assert row["n_chars"] == len(row["text"])
        if name == "decontaminate":  # nothing clean is lost on the way
            left = {(r["doc_id"], r["text"]) for r in docs.collect()}
            assert left == {(d, t) for d, t, _ in rows if t and item not in t}


def test_a_hot_host_does_not_raise_the_limit(spark):
    """A line in nearly a tenth of a large host's documents is taken out."""
    rows = [(i, prose(i, 55) + ("\nRead more on our home page" if i < 150 else ""), "h") for i in range(1600)]
    good = dict(corpus_pipeline.STAGES)["quality_rules"](spark, documents(spark, rows), "").collect()
    assert {r["doc_id"]: r["text"] for r in good} == {i: prose(i, 55) for i in range(1600)}

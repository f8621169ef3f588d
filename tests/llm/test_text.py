from helpers import words
from pyspark.sql import functions as F

from tabloom.llm import text


def test_words_of_odd_texts(spark):
    texts = [None, "", " \n", "a", " a  b\tc\x0bd\x0ce\rf\n", "é x y", "　", "x" * 70_000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = rows.select("i", text.words(F.col("t")).alias("w"), text.word_count(F.col("t")).alias("n")).collect()
    assert {r["i"]: r["w"] for r in got} == {i: words(t) for i, t in enumerate(texts)}
    assert all(r["n"] == len(r["w"]) for r in got)


def test_batches_are_bounded_and_a_lower_bound_stays(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for start, want in (("64m", text.BATCH_BYTES), ("1000", 1000)):
            spark.conf.set(name, start)
            text.bound_batches(spark)
            assert int(spark.conf.get(name).rstrip("b")) == want
    finally:
        spark.conf.set(name, before)


def test_unit_hash_is_uniform_and_knows_missing_keys(spark):
    rows = spark.range(4000).select(text.unit_hash(1, F.col("id")).alias("u"))
    low, high, mean = rows.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.02
    odd = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a")], "p string, q string")
    assert odd.select(text.unit_hash(1, F.col("p"), F.col("q")).alias("u")).distinct().count() == 3

import datetime

from pyspark.sql import functions as F

from tabloom.functions import calendar, hashing, numeric, sequences, text


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_cyclic_distance(spark):
    gaps = [numeric.cyclic_distance(F.lit(a), F.lit(b), 24) for a, b in ((22, 3), (17, 22), (5, 5), (0, 12))]
    assert one(spark, *gaps) == (5, 5, 0, 12)
    missing = numeric.cyclic_distance(F.lit(None).cast("int"), F.lit(3), 24)
    assert one(spark, missing) == (None,)


def test_row_sum_keeps_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.row_sum(["a", "b"])).collect()] == [3.0, None]


def test_ratio_and_percent(spark):
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) == (None,)
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0), 0.0)) == (0.0,)
    assert one(spark, numeric.percent(F.lit(0.12345))) == (12.35,)


def test_tokenize(spark):
    cases = {
        "California est généralement calme en mars.": ["california", "est", "généralement", "calme", "en", "mars"],
        "pendant l' automne.": ["pendant", "l'", "automne"],
        "c\td": ["cd"],
        "a b　c\u0085d\u001ce\rf": ["a", "b", "c", "d", "e", "f"],
        "«Oui» - non?": ["oui", "non"],
        " ...\n": [],
        "": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], ["t"])
    assert {r[0]: r[1] for r in df.select("t", text.tokenize("t")).collect()} == cases
    spaced = df.filter("t = 'c\td'").select(text.tokenize("t", newline_as_space=True)).first()[0]
    assert spaced == ["c", "d"]


def test_white_space_is_what_python_splits_on(spark):
    every = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(f"x{c}y", c) for c in every], ["t", "c"])
    split = {r["c"] for r in df.select("c", text.tokenize("t", characters="").alias("w")).filter(F.size("w") == 2).collect()}
    assert split == {c for c in every if c.isspace()}


def test_padding(spark):
    ids = F.array(*[F.lit(i) for i in (7, 8, 9)])
    assert one(spark, sequences.pad_ids(ids, 8)) == ([1, 7, 8, 9, 2, 0, 0, 0],)
    assert one(spark, sequences.pad_ids(ids, 4)) == ([1, 7, 8, 9],)
    assert one(spark, sequences.pad_ids(F.array().cast("array<int>"), 3)) == ([1, 2, 0],)
    whole = F.array(*[F.lit(i) for i in (1, 7, 2, 0)])
    assert one(spark, sequences.decoder_input(whole, 4), sequences.decoder_target(whole, 4)) == ([1, 7, 2], [7, 2, 0])
    mask = sequences.pad_mask(F.array(*[F.lit(i) for i in (1, 2, 3, 0, 0, 0)]))
    assert one(spark, mask) == ([False, False, False, True, True, True],)


def test_calendar(spark):
    days = [datetime.datetime(2025, 11, 24 + i, 5) for i in range(7)]  # a Monday to a Sunday
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    rows = df.select(
        calendar.day_name("ts"), calendar.day_position("ts"), calendar.day_of_week("ts"), calendar.weekend_flag("ts")
    ).collect()
    assert [r[0] for r in rows] == [d.strftime("%A") for d in days]
    assert [r[1] for r in rows] == list(range(1, 8))
    assert [r[2] for r in rows] == [2, 3, 4, 5, 6, 7, 1]
    assert [r[3] for r in rows] == [0, 0, 0, 0, 0, 1, 1]
    months = spark.createDataFrame([(datetime.datetime(2025, m, 3),) for m in range(1, 13)] + [(None,)], "ts timestamp")
    flags = months.select(calendar.long_month_flag("ts"), calendar.long_month_flag("ts", exact=True)).collect()
    assert [r[0] for r in flags] == [1, 1, 1, 0, 1, 0, 1, 1, 0, 1, 1, 1, 1]
    assert [r[1] for r in flags] == [1, 0, 1, 0, 1, 0, 1, 1, 0, 1, 0, 1, None]


def test_key_digests_tell_parts_and_missing_values_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("", "x"), (None, "x"), ("1:a", "b"), ("a", "1:b")]
    df = spark.createDataFrame(rows, "p string, q string")
    assert df.select(hashing.hash60(["p", "q"], 1).alias("h")).distinct().count() == len(rows)
    assert df.select(hashing.hash60(["p"], 1).alias("h")).distinct().count() == 5

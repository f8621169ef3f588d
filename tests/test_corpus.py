import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabloom.operators import pairs, vocab
from tabloom.plans import corpus
from tabloom.sources import schemas, tables

TEXTS = [(3, "le chat et le chien"), (1, "Le chat."), (2, ""), (7, "chien! rouge")]


@pytest.fixture(scope="module")
def tokens(spark):
    return vocab.tokenized(spark.createDataFrame(TEXTS, "id long, t string").repartition(3), "id", "t")


@pytest.fixture(scope="module")
def words(tokens):
    return vocab.build_vocab(tokens, "id")


def test_vocab_order_is_first_appearance(words):
    rows = {r["token"]: (r["token_id"], r["n"]) for r in words.collect()}
    assert rows == {
        "<PAD>": (0, 0), "<SOS>": (1, 0), "<EOS>": (2, 0),
        "le": (3, 3), "chat": (4, 2), "et": (5, 1), "chien": (6, 2), "rouge": (7, 1),
    }
    assert [r["token"] for r in corpus.vocab_head(words, 4).collect()] == ["<PAD>", "<SOS>", "<EOS>", "le"]
    assert vocab.vocab_size(words).first()[0] == 8


@pytest.mark.parametrize("limits", [False, True])
def test_encode_and_decode(request, spark, tokens, words, limits):
    if limits:
        request.getfixturevalue("small_limits")
        from tabloom import runtime

        runtime.BROADCAST_ROWS = 2
    ids = {r["id"]: r["ids"] for r in vocab.encode(tokens, words, "id", 5).collect()}
    assert ids == {1: [1, 3, 4, 2, 0], 2: [1, 2, 0, 0, 0], 3: [1, 3, 4, 5, 3], 7: [1, 6, 7, 2, 0]}
    strict = {r["id"]: r["ids"] for r in vocab.encode_strict(tokens, words, "id").collect()}
    assert strict == {1: [3, 4], 2: [], 3: [3, 4, 5, 3, 6], 7: [6, 7]}
    other = vocab.tokenized(spark.createDataFrame([(1, "le loup le chat")], "id long, t string"), "id", "t")
    assert vocab.encode(other, words, "id", 7).first()["ids"] == [1, 3, 0, 3, 4, 2, 0]
    encoded = vocab.encode(tokens, words, "id", 5)
    texts = {r["id"]: r["text"] for r in vocab.decode(encoded, words, "id").collect()}
    assert texts[1] == "le chat <EOS> <PAD>" and texts[2] == "<EOS> <PAD> <PAD> <PAD>"


def test_unknown_tokens(spark, words):
    df = spark.createDataFrame([(1, "le loup"), (2, "loup gris")], "id long, t string")
    other = vocab.tokenized(df, "id", "t")
    assert {tuple(r) for r in vocab.unknown_tokens(other, words).collect()} == {("loup", 2), ("gris", 1)}
    with pytest.raises(PySparkException, match="not in the vocabulary"):
        corpus.encode_new_text(df, words, "id", "t").collect()
    lost = spark.createDataFrame([(1, [1, 99])], "id long, ids array<int>")
    with pytest.raises(PySparkException, match="not in the vocabulary"):
        vocab.decode(lost, words, "id").collect()


def test_large_vocabulary_path(spark, small_limits):
    texts = spark.range(200).select("id", F.concat(F.lit("w"), F.col("id") % 90, F.lit(" the the x"), F.col("id")).alias("t"))
    tokens = vocab.tokenized(texts.repartition(5), "id", "t")
    words = vocab.build_vocab(tokens, "id")
    seen, expected = set(), []
    for r in tokens.orderBy("id").collect():
        for t in r["tokens"]:
            if t not in seen:
                seen.add(t)
                expected.append(t)
    got = [r["token"] for r in words.filter("token_id > 2").orderBy("token_id").collect()]
    assert got == expected
    number = {t: i + 3 for i, t in enumerate(expected)}
    for r in vocab.encode(tokens, words, "id", 9).join(tokens, "id").collect():
        plain = [1, *[number[t] for t in r["tokens"]], 2]
        assert r["ids"] == (plain + [0] * 9)[:9]


def test_training_pairs(spark):
    rows = [(i, f"bonjour {i % 5}", f"hello my {i % 7} friend") for i in range(50)]
    table = pairs.training_pairs(spark.createDataFrame(rows, "id long, source string, target string"), "id", 6)
    got = table.collect()
    assert len(got) == 50 and sum(r["split"] == "train" for r in got) == 40
    for r in got:
        assert len(r["src_ids"]) == 6 and len(r["tgt_in"]) == len(r["tgt_out"]) == len(r["tgt_pad"]) == 5
        assert r["tgt_in"][1:] == r["tgt_out"][:-1] and r["src_ids"][0] == r["tgt_in"][0] == 1
        assert r["src_pad"] == [i == 0 for i in r["src_ids"]] and r["tgt_pad"] == [i == 0 for i in r["tgt_in"]]


def test_csv_with_header(spark, tmp_path):
    path = str(tmp_path / "patients.csv")
    names = ",".join(schemas.PATIENT_SCHEMA.names)
    with open(path, "w") as f:
        f.write(f"{names}\n1,90,60,20,0,21.5,0.3,25,0\n2,150,80,30,100,35.1,0.8,44,1\n")
    rows = tables.read_csv(spark, path, schemas.PATIENT_SCHEMA).collect()
    assert rows[1]["BMI"] == 35.1 and rows[1]["Outcome"] == 1 and len(rows) == 2
    with open(path, "a") as f:
        f.write("x,1,1,1,1,1,1,1,1\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="Malformed"):
        tables.read_csv(spark, path, schemas.PATIENT_SCHEMA).collect()


def test_numbered_lines(spark, tmp_path):
    lines = [f"line {i}, rest" if i % 3 else f'"line {i}, quoted"' for i in range(2000)]
    for part in range(2):
        with open(tmp_path / f"part-{part}.csv", "w") as f:
            f.write("\n".join(lines[part * 1200 : part * 1200 + (1200 if part == 0 else 800)]) + "\n\n")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r["row"]: r["text"] for r in tables.read_numbered_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    assert got == {i: (f"line {i}" if i % 3 else f"line {i}, quoted") for i in range(2000)}


def test_counts_and_samples(tokens):
    assert tuple(corpus.corpus_counts(tokens, "id").first()) == (4, 9)
    assert {r["id"] for r in corpus.sample_lines(tokens, "id", (1, 7, 99)).collect()} == {1, 7}


@pytest.mark.parametrize("length", [10, 66])
def test_rows_that_share_a_key_are_errors(spark, length):
    tokens = vocab.tokenized(spark.createDataFrame([(1, "a b"), (1, "c d e")], "k long, s string"), "k", "s")
    with pytest.raises(Exception, match="rows share the key"):
        vocab.encode(tokens, vocab.build_vocab(tokens, "k"), "k", length).collect()


@pytest.mark.parametrize("rows", [10**6, 4, 0])
def test_own_counts_spare_the_pass_that_takes_them(spark, monkeypatch, rows):
    from tabloom import runtime
    from tabloom.operators import lookup

    texts = [(1, "a b a c"), (2, ""), (3, "a d b e f"), (None, "a g"), (5, None)]
    tokens = vocab.tokenized(spark.createDataFrame(texts, "k long, s string"), "k", "s")
    words = vocab.build_vocab(tokens, "k")
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", rows)
    expected = {r["k"]: r["ids"] for r in vocab.encode_strict(tokens, words, "k").collect()}
    monkeypatch.setattr(lookup.runtime, "store", lambda *_: pytest.fail("the uses were counted"))
    assert {r["k"]: r["ids"] for r in vocab.encode_strict(tokens, words, "k", own=True).collect()} == expected
    assert expected[2] == expected[5] == [] and len(expected[3]) == 5 and expected[1][0] == expected[1][2]
    lost = vocab.tokenized(spark.createDataFrame([(1, "a x")], "k long, s string"), "k", "s")
    with pytest.raises(PySparkException, match="not in the vocabulary"):
        vocab.encode_strict(lost, words, "k", own=True).collect()


@pytest.mark.parametrize("shift", [0, -(1 << 31), (1 << 31) - 3, 1 << 31, (1 << 62) + 1, -(1 << 63)])
def test_first_places_of_small_and_large_keys(spark, shift):
    df = spark.createDataFrame([(shift + 2, ["b", "a", "b"]), (shift, ["c", "b"]), (None, ["d", "a"])], "k long, tokens array<string>")
    found = vocab.first_occurrences(df, "k")
    kind = "decimal" if not -(1 << 31) <= shift < (1 << 31) - 2 else "bigint"
    assert {tuple(r) for r in found.collect()} == {
        ("a", 2, shift + 2, 1), ("b", 3, shift, 1), ("c", 1, shift, 0), ("d", 1, None, None)
    }
    assert ("decimal" in found._jdf.queryExecution().optimizedPlan().toString()) == (kind == "decimal")


@pytest.mark.parametrize("kind", ["long", "string", "date"])
def test_long_rows_are_put_together_before_they_are_grouped(spark, kind):
    key = F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")) if kind == "date" else F.col("id").cast(kind)
    words = F.transform(F.sequence(F.lit(0), F.col("id") * 97), lambda i: F.concat(F.lit("w"), F.pmod(i * 7, F.lit(1009))))
    df = spark.range(1, 300).select(key.alias("k"), words.alias("tokens"))
    df = df.unionByName(spark.createDataFrame([(None, ["w3", "w1"])], f"k {kind}, tokens array<string>")).repartition(3)
    every = F.transform(F.sequence(F.lit(0), F.lit(1008)), lambda i: F.concat(F.lit("w"), i))
    table = vocab.build_vocab(spark.range(1).select("id", every.alias("tokens")), "id")
    numbers = {r["token"]: r["token_id"] for r in table.collect()}
    encoded = vocab.encode_strict(df, table, "k")
    assert ("MapInArrow" in encoded._jdf.queryExecution().executedPlan().toString()) == (kind != "date")
    told = {r["k"]: r["ids"] for r in encoded.collect()}
    assert told == {r["k"]: [numbers[t] for t in r["tokens"]] for r in df.collect()}
    with pytest.raises(Exception, match="rows share the key"):
        vocab.encode_strict(df.filter("k IS NOT NULL").unionByName(df.filter("k IS NOT NULL")), table, "k").collect()

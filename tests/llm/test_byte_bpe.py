import hashlib
import random
import struct

import pytest
import tiktoken
from helpers import documents, prose
from pyspark.sql import functions as F

from tabloom.llm import byte_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path(byte_bpe.RANKS)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = byte_bpe.load_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(seed, n):
    rng = random.Random(seed)
    marks = list(" \n\t\r'strvmldeaZ9.!é中''") + ["'re", "'ll", "  ", "　", "\U0001f600", "½", "́", "\x85", "'S", "ⅷ", "<|endoftext|>"]
    return ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def encoded(spark, texts, *extra):
    docs = documents(spark, list(enumerate(texts)), *extra)
    return byte_bpe.encode(docs, RANKS)


def test_equals_the_library(spark, library):
    texts = odd_texts(1, 3000) + [None, "", " ", "\n", "'", "it's we'll they'red 'tis O'Neil'S"]
    rows = encoded(spark, texts, "body", "key", "ids", "starts").collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_very_long_texts_and_long_runs(spark, library):
    texts = ["a" * 60_000, " " * 50_000 + "x", "'" * 30_000 + "s", prose(1, 200_000), "\n" * 9_999, "x'll " * 20_000]
    rows = encoded(spark, texts).collect()
    for row in rows:
        assert row["ids"] == library.encode_ordinary(texts[row["doc_id"]])


def test_decoding_and_the_retained_starts(spark, library):
    texts = odd_texts(2, 500) + [None, "", prose(3, 5000)]
    frame = byte_bpe.decode(encoded(spark, texts).withColumn("decoded", F.lit("clash")), RANKS)
    for row in frame.collect():
        body = (texts[row["doc_id"]] or "").encode()
        assert bytes(row["decoded"]) == body
        ends = [*row["starts"][1:], len(body)]
        assert [library.decode_single_token_bytes(i) for i in row["ids"]] == [body[a:b] for a, b in zip(row["starts"], ends)]


def test_blocks_of_the_scan_meet_anywhere(library, monkeypatch):
    """Where a block ends must not matter."""
    import numpy as np

    classes = byte_bpe.class_table()
    for block in (1, 2, 3, 7, 128):
        monkeypatch.setattr(byte_bpe, "_BLOCK", block)
        for body in odd_texts(block, 200):
            data = body.encode()
            if data:
                starts = byte_bpe.pre_tokens(data, np.array([0]), classes).tolist()
                parts = [data[a:b].decode() for a, b in zip(starts, [*starts[1:], len(data)])]
                assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(body)


def test_products_of_functions_are_associative():
    _, _, _, product, functions = byte_bpe.automaton()
    rng = random.Random(5)
    for _ in range(2000):
        a, b, c = (rng.randrange(len(functions)) for _ in range(3))
        assert product[product[a, b], c] == product[a, product[b, c]]
        assert (functions[product[a, b]] == functions[b][functions[a]]).all()


def test_missing_ids_repeated_rows_and_empty_tables(spark):
    docs = documents(spark, [(None, "ab"), (None, "ab"), (3, None)])
    rows = byte_bpe.encode(docs, RANKS).collect()
    assert sorted(len(r["ids"]) for r in rows) == [0, 1, 1]
    assert byte_bpe.decode(byte_bpe.encode(documents(spark, []), RANKS), RANKS).count() == 0


def test_wrong_ids_and_starts_fail(spark):
    frame = spark.createDataFrame([(1, [10_000_000], [0])], "doc_id long, ids array<int>, starts array<int>")
    with pytest.raises(Exception, match="no rank"):
        byte_bpe.decode(frame, RANKS).collect()
    frame = spark.createDataFrame([(1, [5, 5], [0, 7])], "doc_id long, ids array<int>, starts array<int>")
    with pytest.raises(Exception, match="do not fit"):
        byte_bpe.decode(frame, RANKS).collect()


def test_query_equals_brute_force(spark, library, tmp_path):
    texts = odd_texts(4, 50) + [None, "", "x y", "x y"]
    documents(spark, [*enumerate(texts), (0, texts[0])]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = byte_bpe.op11_byte_bpe(spark, str(tmp_path)).collect()
    expected = []
    for i, body in [*enumerate(texts), (0, texts[0])]:
        ids = library.encode_ordinary(body or "")
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256((body or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in rows) == sorted(expected)

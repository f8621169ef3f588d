import random

import public_tokenizers
import pytest
from helpers import documents
from sentencepiece import SentencePieceProcessor

from tabloom.llm import token_counts

MODEL = public_tokenizers.path(token_counts.TOKENIZER)


def texts(n):
    rng = random.Random(9)
    pieces = list(" \n\t abcdefgABC.,!?0123ééßñ中文😀▁　") + ["<s>", "</s>", "<unk>", "<0x0A>", "the ", "ing", "  "]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_equals_the_library(spark):
    known = SentencePieceProcessor(model_file=MODEL)
    rows = list(enumerate([*texts(2000), None, "", " ", "\n", "▁", "word " * 5000, "x" * 100_000]))
    out = token_counts.count_tokens(documents(spark, rows, "key", "body", "n_tokens"), MODEL).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out}
    n = {i: len(known.encode(t or "")) for i, t in rows}
    assert got == {i: (len((t or "").encode()), n[i], n[i] > 4096) for i, t in rows}


def test_the_sent_table_and_the_cache_change_no_count(spark, monkeypatch):
    rows = list(enumerate(texts(300)))
    want = sorted(map(tuple, token_counts.count_tokens(documents(spark, rows), MODEL).collect()))
    monkeypatch.setattr(token_counts, "TABLE_ENTRIES", 10)
    monkeypatch.setattr(token_counts, "_CACHE_ENTRIES", 3)
    monkeypatch.setattr(token_counts, "_COUNTED", 50)
    assert sorted(map(tuple, token_counts.count_tokens(documents(spark, rows), MODEL).collect())) == want


def test_byte_level_ranks(spark):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = list(enumerate(texts(300)))
    out = token_counts.count_tokens(documents(spark, rows), path).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in out} == {i: len(known.encode_ordinary(t)) for i, t in rows}


def test_empty_table_and_repeated_rows(spark):
    assert token_counts.count_tokens(documents(spark, []), MODEL).count() == 0
    twice = token_counts.count_tokens(documents(spark, [(1, "a b"), (1, "a b"), (None, "c")]), MODEL)
    assert twice.count() == 3
    with pytest.raises(ValueError):
        token_counts.load_pieces("other.vocab", b"")

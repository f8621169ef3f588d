"""Token counts of whole texts without shuffling pre-tokens.

A text is cut into pre-tokens at places that no piece of the vocabulary crosses, so the length
of a text is the sum of the lengths of its pre-tokens. The lengths of frequent pre-tokens are
looked up in a table that is sent to every worker; other pre-tokens are encoded by the library
once per worker and remembered in a cache of fixed size.

The table holds pre-tokens that make up at least ``1 / TABLE_ENTRIES`` of all, so it has at most
that many entries. They are found in one pass in which each task counts its own pre-tokens and
sends only those that are frequent within it; the table decides speed only, never a count.

Defined cases: a missing or empty text has 0 bytes and 0 tokens; rows that repeat are counted
each; an empty table gives an empty result; only the key and the counts are returned.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

TOKENIZER = "piece_bpe_32k.model"
LIMIT = 4096
TABLE_ENTRIES = 50_000
_TASK_SHARE = 10_000  # a task reports pre-tokens that are this share of its own
_COUNTED = 500_000  # pre-tokens a task counts at a time
_CACHE_ENTRIES = 500_000
_SPACE = "▁"


@dataclass(frozen=True)
class Pieces:
    """How a tokenizer cuts texts: ``cut`` into pre-tokens, ``length`` of one of them."""

    cut: Callable[[str], list[str]]
    length: Callable[[str], int]


def sentence_pieces(model: bytes) -> Pieces:
    """A piece model with a dummy prefix and pieces that hold blanks at their start only.

    Pre-tokens are runs of blanks or line feeds with what follows up to the next one.
    """
    from sentencepiece import SentencePieceProcessor

    known = SentencePieceProcessor(model_proto=model)
    ids = range(known.get_piece_size())
    inner = [p for p in (known.id_to_piece(i) for i in ids) if _SPACE in p.lstrip(_SPACE) or "\n" in p]
    if inner or known.encode("\n\n") != known.encode("\n") + known.encode("\n")[1:]:
        raise ValueError("the vocabulary has pieces across blanks or line feeds")
    cut_at = re.compile(r" +[^ \n]*|\n+[^ \n]*").findall

    def cut(body: str) -> list[str]:
        return cut_at(" " + body.replace(_SPACE, " ")) if body else []

    def length(part: str) -> int:
        if part == " ":
            return 1
        return len(known.encode(part[1:])) if part[0] == " " else len(known.encode(part)) - 1

    return Pieces(cut, length)


def rank_pieces(ranks: bytes, pattern: str) -> Pieces:
    """A byte-level model given as ranks; its pattern cuts the pre-tokens."""
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    known = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    return Pieces(regex.compile(pattern).findall, lambda part: len(known.encode_ordinary(part)))


def load_pieces(name: str, content: bytes) -> Pieces:
    if name.endswith(".model"):
        return sentence_pieces(content)
    if name.endswith(".tiktoken"):
        from public_tokenizers import PATTERN

        return rank_pieces(content, PATTERN)
    raise ValueError(f"no way to cut texts for {name}")


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def frequent(docs: DataFrame, body: str, name: str, content: bytes) -> list[str]:
    """Pre-tokens that make up at least 1 / ``TABLE_ENTRIES`` of all."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts, total = load_pieces(name, content).cut, Counter(), 0
        for batch in batches:
            for body in _texts(batch.column(0)):
                parts = cut(body)
                total += len(parts)
                counts.update(parts)
                if len(counts) > _COUNTED:
                    counts = Counter({p: n for p, n in counts.items() if n * _TASK_SHARE >= total})
        told = {p: n for p, n in counts.items() if n * _TASK_SHARE >= total}
        yield pa.record_batch(
            [pa.array([*told, None], pa.string()), pa.array([*told.values(), total], pa.int64())], ["part", "n"]
        )

    told = docs.select(F.col(body).alias("body")).mapInArrow(task, "part string, n long")
    counted = runtime.store(told.groupBy("part").agg(F.sum("n").alias("n")), "parts")  # read twice, counted once
    total = counted.filter(F.col("part").isNull()).first()
    least = max(1, (total["n"] if total else 0) / TABLE_ENTRIES)
    return [row["part"] for row in counted.filter(F.col("part").isNotNull() & (F.col("n") >= least)).collect()]


class _Lengths(dict):
    """Lengths by pre-token: the sent table, and what this worker has encoded itself."""

    def __init__(self, table: dict[str, int], length: Callable[[str], int]):
        super().__init__(table)
        self.table, self.length = table, length

    def __missing__(self, part: str) -> int:
        if len(self) > len(self.table) + _CACHE_ENTRIES:
            self.clear()
            self.update(self.table)
        n = self[part] = self.length(part)
        return n


def count_tokens(
    docs: DataFrame, tokenizer_path: str, *, key: str = "doc_id", body: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit``, one row per row of ``docs``.

    The tokenizer's file is read here and travels with the job.
    """
    text.bound_batches(docs.sparkSession)
    with open(tokenizer_path, "rb") as file:
        name, content = tokenizer_path, file.read()
    pieces = load_pieces(name, content)
    table = {part: pieces.length(part) for part in frequent(docs, body, name, content)}
    sent = docs.sparkSession.sparkContext.broadcast((content, table))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = sent.value
        known = load_pieces(name, own)
        cut, lengths = known.cut, _Lengths(table, known.length)
        look = lengths.__getitem__
        for batch in batches:
            counts = [sum(map(look, cut(body))) for body in _texts(batch.column(2))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["key", "n_bytes", "n_tokens"])

    narrow = docs.select(
        F.col(key).alias("key"),
        F.octet_length(text.whole(F.col(body))).cast("long").alias("n_bytes"),
        text.whole(F.col(body)).alias("body"),
    )
    kind = narrow.schema["key"].dataType.simpleString()
    counted = narrow.mapInArrow(task, f"key {kind}, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("key", key).withColumn("over_limit", F.col("n_tokens") > limit)


@CATALOG.query()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = text.table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path(TOKENIZER))

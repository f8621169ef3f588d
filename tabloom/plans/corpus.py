"""From two paired line files to model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import columns, pairs, vocab
from tabloom.sources import tables


def read_pairs(spark: SparkSession, source: str, target: str, *, multi_line: bool = False) -> DataFrame:
    """Table (row, source, target) of two headerless files paired by line position."""
    return pairs.pair_by_key(
        tables.read_numbered_lines(spark, source, multi_line=multi_line),
        tables.read_numbered_lines(spark, target, multi_line=multi_line),
        "row",
    )


def sample_lines(df: DataFrame, position: str, positions: tuple[int, ...] = (0, 1000, 3000)) -> DataFrame:
    return columns.rows_at(df, position, positions)


def vocab_head(table: DataFrame, rows: int = 10) -> DataFrame:
    """First entries of a vocabulary."""
    return columns.top_rows(table.select("token_id", "token"), ["token_id"], rows)


def corpus_counts(df: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """One row: sentences and tokens."""
    return df.agg(F.count(key).alias("sentences"), F.sum(F.size(tokens)).cast("long").alias("tokens"))


def encode_new_text(df: DataFrame, table: DataFrame, key: str, column: str) -> DataFrame:
    """Ids of new sentences by a finished vocabulary; an unknown token is an error."""
    return vocab.encode_strict(vocab.tokenized(df, key, column), table, key)

"""Paired corpora and training tables for sequence models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.functions import sequences, text
from tabloom.operators import rank, split, vocab


def pair_by_key(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Table (key, source, target) of two text tables (key, text) sharing a unique key."""
    left = source.select(key, F.col("text").alias("source"))
    right = target.select(key, F.col("text").alias("target"))
    return left.join(right, key)


def tokenized_pairs(pairs: DataFrame, key: str) -> DataFrame:
    return runtime.spread(pairs.select(key, "source", "target"), key).select(key, text.tokenize("source").alias("src_tokens"), text.tokenize("target").alias("tgt_tokens"))


def training_pairs(
    pairs: DataFrame,
    key: str,
    length: int,
    *,
    train_fraction: float = 0.8,
    seed: int = 42,
    vocabs: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Model inputs from a (key, source, target) table.

    Columns: key, src_ids, tgt_in, tgt_out, src_pad, tgt_pad, split. The first
    ``int(train_fraction * rows)`` rows in a seeded random order train. Source and target
    are encoded separately and joined on the unique key they are both grouped by.
    """
    # stored in the order of the key and numbered in it, once for both vocabularies and both encodings
    tokens = runtime.store(rank.ordered_rank(tokenized_pairs(pairs, key), "pair__number", [key]), "tokens")
    if vocabs is None:
        vocabs = tuple(vocab.build_vocab(tokens, "pair__number", side) for side in ("src_tokens", "tgt_tokens"))
    source = vocab.encode(tokens, vocabs[0], key, length, tokens="src_tokens", out="src_ids")
    target = vocab.encode(tokens, vocabs[1], key, length, tokens="tgt_tokens", out="tgt_ids")
    shifted = source.join(target, key).select(
        key,
        "src_ids",
        sequences.decoder_input("tgt_ids", length).alias("tgt_in"),
        sequences.decoder_target("tgt_ids", length).alias("tgt_out"),
        sequences.pad_mask("src_ids").alias("src_pad"),
        sequences.pad_mask(sequences.decoder_input("tgt_ids", length)).alias("tgt_pad"),
    )
    sides = split.exact_split(pairs.select(key), [key], train_fraction, seed)
    return shifted.join(sides, key)

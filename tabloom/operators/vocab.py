"""Vocabularies as tables (token, n, token_id)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom import runtime
from tabloom.functions import sequences, text
from tabloom.operators import lookup, rank


def tokenized(df: DataFrame, key: str, column: str, **options) -> DataFrame:
    """Table (key, tokens)."""
    return runtime.spread(df.select(key, column), key).select(key, text.tokenize(column, **options).alias("tokens"))


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Table (token, n)."""
    # a plain explode makes Spark test the array for emptiness first, which tokenizes every text again
    words = df.select(F.explode_outer(tokens).alias("token")).filter(F.col("token").isNotNull())
    return words.groupBy("token").agg(F.count("*").alias("n"))


def first_occurrences(df: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Table (token, n, first_key, first_pos): count and first place, in one aggregation.

    Occurrences are combined before they leave their task, so a frequent token costs one row per task. The
    place is packed into one number, because Spark sorts all occurrences to find a smallest struct but
    hashes to find a smallest number: a long, or a decimal if a key needs more than 32 bits. Documents whose
    key is no integer are numbered in its order first.
    """
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        numbered = rank.ordered_rank(df.select(key, tokens), "first__number", [key])
        found = first_occurrences(numbered, "first__number", tokens).withColumnRenamed("first_key", "first__number")
        keys = numbered.select("first__number", F.col(key).alias("first_key"))
        return found.join(keys, "first__number").select("token", "n", "first_key", "first_pos")
    places = _places(df, key, tokens, "token").filter(F.col("token").isNotNull())
    least, most = df.agg(F.min(key), F.max(key)).first()
    fits = least is None or (least >= -(1 << 31) and most < 1 << 31)
    step = F.lit(1 << 31).cast("long" if fits else "decimal(10,0)")
    place = F.col(key).cast("long" if fits else "decimal(19,0)") * step + F.col("pos")
    found = places.groupBy("token").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    pos = F.pmod("first", step)
    whole = F.shiftright("first", 31) if fits else (F.col("first") - pos) / step
    return found.select(
        "token", "n", whole.cast(df.schema[key].dataType).alias("first_key"), pos.cast("int").alias("first_pos")
    )


def special_rows(spark: SparkSession) -> DataFrame:
    rows = [{"token": t, "n": 0, "token_id": i} for i, t in enumerate(sequences.SPECIAL_TOKENS)]
    schema = pa.schema([("token", pa.string()), ("n", pa.int64()), ("token_id", pa.int64())])
    return runtime.local_table(spark, rows, schema)


def build_vocab(df: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Number the distinct tokens from 3 on, in order of first appearance by (key, position).

    The special tokens take 0, 1 and 2. The table is stored, since encoding reads it
    several times.
    """
    ranked = rank.ordered_rank(first_occurrences(df, key, tokens), "rank__1", ["first_key", "first_pos"])
    shift = len(sequences.SPECIAL_TOKENS) - 1
    words = ranked.select("token", "n", (F.col("rank__1") + shift).alias("token_id"))
    return runtime.store(special_rows(df.sparkSession).unionByName(words), "vocab")


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count("*").alias("entries"))


def unknown_tokens(df: DataFrame, vocab: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Tokens that the vocabulary lacks, with their counts.

    Occurrences are counted first, so the join sees every token once.
    """
    return token_counts(df, tokens).join(vocab.select("token"), "token", "left_anti")


def _places(df: DataFrame, key: str, column: str, item: str) -> DataFrame:
    """(key, pos, item) per array element; an empty array keeps one row without a position."""
    return df.select(key, F.posexplode_outer(column).alias("pos", item))


def _required(found: DataFrame, item: str, value: str) -> DataFrame:
    """Fail on an element whose lookup found nothing."""
    message = F.concat(F.lit(f"not in the vocabulary: {item} "), F.col(item).cast("string"))
    lost = F.col("pos").isNotNull() & F.col(value).isNull()
    kind = found.schema[value].dataType
    return found.withColumn(value, F.when(lost, F.raise_error(message).cast(kind)).otherwise(F.col(value)))


def _regroup_pieces(places: DataFrame, key: str, item: str, out: str) -> DataFrame:
    """Like :func:`_regroup` for integer items, with neighbours put together before the rows are grouped.

    Spark's aggregation sorts all elements of a task that has more than a few keys; here it gets about a row per key.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))
            edges = np.concatenate([[0], runs.run_ends.to_numpy()]).astype(np.int32)
            items = pa.ListArray.from_arrays(pa.array(edges), batch.column(1))
            counts = pa.array(np.diff(edges).astype(np.int64))
            yield pa.RecordBatch.from_arrays([runs.values, items, counts], ["key", "items", "n"])

    pair = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col(item).cast("long"))
    kind = places.schema[key].dataType.simpleString()
    pieces = places.select(F.col(key).alias("key"), F.when(F.col("pos").isNotNull(), pair).alias("item")).mapInArrow(
        task, f"key {kind}, items array<bigint>, n bigint"
    )
    gathered = pieces.groupBy("key").agg(F.flatten(F.collect_list("items")).alias("items"), F.sum("n").alias("n"))
    gathered = gathered.select("key", F.array_sort(F.array_compact("items")).alias("items"), "n")
    last = F.shiftright(F.try_element_at("items", F.lit(-1)), 32)
    message = F.concat(F.lit("rows share the key "), F.col("key").cast("string"))
    shared = F.col("n") != F.coalesce(last + 1, F.lit(1))
    checked = F.when(shared, F.raise_error(message).cast("array<bigint>")).otherwise(F.col("items"))
    low = F.lit((1 << 32) - 1)
    return gathered.select(F.col("key").alias(key), F.transform(checked, lambda x: x.bitwiseAND(low).cast("int")).alias(out))


def _regroup(places: DataFrame, key: str, item: str, out: str) -> DataFrame:
    """Arrays in position order, one per key.

    Elements of a row sit in one task after the broadcast join and are combined there, so
    about one array per row is shuffled. An id travels with its position in one long. Two rows with one key are an error.
    """
    packed = isinstance(places.schema[item].dataType, T.IntegerType)
    pair = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col(item).cast("long")) if packed else F.struct("pos", item)
    pair = F.when(F.col("pos").isNotNull(), pair)
    gathered = places.groupBy(key).agg(
        F.array_sort(F.collect_list(pair)).alias("items"), F.count("*").alias("n"), F.max("pos").alias("last")
    )
    message = F.concat(F.lit("rows share the key "), F.col(key).cast("string"))
    shared = F.col("n") != F.coalesce(F.col("last") + 1, F.lit(1))
    checked = F.when(shared, F.raise_error(message).cast(gathered.schema["items"].dataType)).otherwise(F.col("items"))
    low = F.lit((1 << 32) - 1)
    value = (lambda x: x.bitwiseAND(low).cast("int")) if packed else (lambda x: x[item])
    return gathered.select(key, F.transform(checked, value).alias(out))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    length: int,
    *,
    tokens: str = "tokens",
    out: str = "ids",
) -> DataFrame:
    """Table (key, ids): padded id sequences of exactly ``length``; unknown tokens become PAD.

    Ids at positions past ``length`` are cut by definition, so those tokens are not looked
    up. ``key`` must identify a row.
    """
    kept = df.select(key, F.slice(tokens, 1, length - 1).alias("kept"))
    found = lookup.lookup_join(_places(kept, key, "kept", "token"), "token", vocab.drop("n"), "token")
    known = found.withColumn("token_id", F.coalesce("token_id", F.lit(sequences.PAD)).cast("int"))
    return _regroup(known, key, "token_id", "known").select(key, sequences.pad_ids("known", length).alias(out))


def encode_strict(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    *,
    tokens: str = "tokens",
    out: str = "ids",
    own: bool = False,
) -> DataFrame:
    """Table (key, ids) without marks and padding.

    An unknown token fails the job when the result is computed; :func:`unknown_tokens`
    lists them beforehand. ``own`` says that the vocabulary is that of these very texts, so that its
    counts are theirs and need not be taken again.
    """
    places, words = _places(df, key, tokens, "token"), vocab if own else vocab.drop("n")
    found = lookup.lookup_join(places, "token", words, "token", counts="n" if own else None)
    known = _required(found, "token", "token_id").withColumn("token_id", F.col("token_id").cast("int"))
    runs = isinstance(df.schema[key].dataType, (T.IntegralType, T.StringType))
    return (_regroup_pieces if runs else _regroup)(known, key, "token_id", out)


def decode(df: DataFrame, vocab: DataFrame, key: str, *, ids: str = "ids", skip: int = 1, out: str = "text") -> DataFrame:
    """Table (key, text): tokens of the ids after the first ``skip``, joined by spaces.

    An id that the vocabulary lacks is an error.
    """
    kept = df.select(key, F.slice(ids, skip + 1, F.greatest(F.size(ids), F.lit(1))).alias("kept"))
    wanted = _places(kept, key, "kept", "token_id").withColumn("token_id", F.col("token_id").cast("long"))
    found = lookup.lookup_join(wanted, "token_id", vocab.drop("n"), "token_id")
    return _regroup(_required(found, "token_id", "token"), key, "token", "words").select(
        key, text.join_words("words").alias(out)
    )

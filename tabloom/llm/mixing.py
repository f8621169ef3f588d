"""Mix sources to target weights by repeating documents.

Sizes are summed per source (combined on the map side, so a source that holds most rows costs
no more than another). Targets share the total by weight; a target stops at ``most`` times its
source's size and the excess goes to the others. The repetition rate of a source is
target / size: every document is emitted floor(rate) times, and once more if a seeded hash falls
below the fraction. The hash is of the key and of the text, so different texts under one key or without a
key are decided one by one (:func:`mix` without ``body`` goes by the key alone).

Defined cases: a missing text has size 0; a missing source is a source of its own, ordered
last; a source of size 0 has target 0 and none of its documents is emitted; equal rows get the
same decision; an empty table gives an empty result. Other columns pass
through; ``copy`` replaces a column of that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import text
from tabloom.operators import rank
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20


def source_rates(
    sized: DataFrame, source: str, size: str, *, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """One row per source: ``mix__source``, ``source_size``, ``target`` and ``rate``.

    Weights go round over the sources in code point order. Only sums come to the driver.
    """
    sums = sized.groupBy(F.col(source).alias("mix__source")).agg(F.sum(size).alias("source_size"))
    ranked = rank.ordered_rank(runtime.store(sums, "sources"), "mix__rank", [F.asc_nulls_last("mix__source")])
    turn = ((F.col("mix__rank") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1).cast("long")
    sources = runtime.store(ranked.withColumn("mix__weight", weight).drop("mix__rank"), "sources")
    cap, level = F.lit(most) * F.col("source_size"), _level(sources, most)
    share = F.col("mix__weight") * F.lit(level)
    target = F.when(share > cap, cap.cast("double")).otherwise(share)
    return sources.withColumn("target", target).select(
        "mix__source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def _level(sources: DataFrame, most: int) -> float:
    """Words per unit of weight once no target is above its limit.

    Sources over the limit at one level stay so at any higher one, so the level only rises and
    the loop ends when no further source is over.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, over = 0.0, F.lit(False)
    seen = -1
    while True:
        capped, rest, count = sources.agg(
            F.sum(F.when(over, F.lit(most) * F.col("source_size")).otherwise(F.lit(0))),
            F.sum(F.when(over, F.lit(0)).otherwise(F.col("mix__weight"))),
            F.sum(over.cast("long")),
        ).first()
        if count == seen or not rest:
            return level
        seen = count
        level = float(total - capped) / float(rest)
        over = F.col("mix__weight") * F.lit(level) > F.lit(most) * F.col("source_size")


def with_copies(sized: DataFrame, rates: DataFrame, source: str, *keys: str, seed: int = SEED) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies``, the number of times a document is emitted; ``keys`` tell documents apart."""
    joined = sized.join(rates, F.col(source).eqNullSafe(F.col("mix__source")), "left").drop("mix__source")
    whole = F.floor("rate")
    extra = text.unit_hash(seed, *map(F.col, keys)) < F.col("rate") - whole
    return joined.withColumn("copies", whole.cast("long") + extra.cast("long")).drop("rate")


def emit(counted: DataFrame) -> DataFrame:
    """Repeat rows; ``copy`` numbers the repeats of a row from 1."""
    numbers = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    copies = F.when(F.col("copies") > 0, numbers).otherwise(F.array().cast("array<bigint>"))
    return counted.withColumn("copy", F.explode(copies)).drop("copies")


def mix(
    docs: DataFrame, size: Column, *, source: str = "source", key: str = "doc_id", body: str | None = None, seed: int = SEED
) -> DataFrame:
    """The mixture itself: the columns of ``docs`` and ``copy``; ``body`` tells rows with one key apart."""
    plain = docs.drop("copy")
    own = {"key": F.col(key)} | ({} if body is None else {"body_hash": F.xxhash64(body)})
    parts = [F.col(source).alias("of"), size.alias("size"), *(c.alias(name) for name, c in own.items())]
    packed = plain.select(F.struct(*plain.columns).alias("row"), *parts)
    counted = with_copies(packed, source_rates(packed, "of", "size"), "of", *own, seed=seed)
    return emit(counted).select("row.*", "copy")


@CATALOG.query(
    rf"""
    WITH sized AS (
      SELECT doc_id, source, md5(coalesce(text, '')) AS body_hash, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
      FROM documents
    ),
    sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (
      SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM sums
    ),
    levels AS (
      SELECT a.source_size * 3.0::DOUBLE / a.w AS border,
        ((SELECT sum(source_size) FROM weighed)
          - coalesce(sum(3 * b.source_size) FILTER (b.source_size * a.w < a.source_size * b.w), 0))::BIGINT::DOUBLE
        / (sum(b.w) FILTER (b.source_size * a.w >= a.source_size * b.w))::BIGINT::DOUBLE AS level
      FROM weighed a, weighed b GROUP BY a.source, a.source_size, a.w
    ),
    found AS (SELECT level FROM levels WHERE level <= border ORDER BY border LIMIT 1),
    targets AS (
      SELECT source, source_size,
        CASE WHEN w * level > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE w * level END AS target
      FROM weighed, found
    ),
    rated AS (
      SELECT s.doc_id, s.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        ('0x' || substr(md5('{SEED}|' || coalesce(s.doc_id::VARCHAR, 'null') || '|' || s.body_hash), 1, 12))::BIGINT
          / 281474976710656.0::DOUBLE AS u
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
      size * (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT) AS taken
    FROM rated
    """
)
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.table(spark, folder, "documents")
    own = [text.word_count(F.col("text")).alias("size"), F.md5(text.whole(F.col("text"))).alias("body_hash")]
    sized = runtime.store(docs.select("doc_id", "source", *own), "sized")
    counted = with_copies(sized, source_rates(sized, "source", "size"), "source", "doc_id", "body_hash")
    return counted.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )

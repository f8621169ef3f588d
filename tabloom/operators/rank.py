"""Exact global ranks and running sums without a one-task window.

Rows get an order-preserving bucket number. Bucket sizes are counted (map-side combined),
their running sum gives the offset of each bucket, and a window inside the bucket does the
rest. No task ever sees more than one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom import runtime
from tabloom.functions import hashing

_ORDERED_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def bucket_bits(spark: SparkSession) -> int:
    """Bits of the bucket number: eight buckets per shuffle partition, up to a million buckets."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(20, max(4, (partitions * 8 - 1).bit_length()))


def hash_bucket(order: Column, spark: SparkSession) -> Column:
    """Top bits of a 60-bit uniform hash."""
    return F.shiftright(order, 60 - bucket_bits(spark)).cast("int")


def as_number(df: DataFrame, column: str) -> Column:
    """A double that never decreases as ``column`` grows."""
    kind = df.schema[column].dataType
    if not isinstance(kind, _ORDERED_TYPES):
        raise TypeError(f"{column} is {kind.simpleString()}; ordering needs a number, a date or a timestamp")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # seconds on the zoneless clock: a session zone with daylight saving would step back
        return F.unix_date(F.col(column).cast("date")) * F.lit(86_400.0) + (
            F.hour(column) * 3600 + F.minute(column) * 60 + F.date_part(F.lit("SECOND"), column).cast("double")
        )
    return F.col(column).cast("double")


def value_bucketed(df: DataFrame, column: str, out: str, *, descending: bool = False) -> DataFrame:
    """Add ``out``, a bucket number that follows the order of a numeric column.

    Borders are approximate quantiles of the column, so buckets hold similar row counts;
    they only balance the work and do not affect the result. There are 4096 buckets at most,
    since the borders travel with the plan.
    """
    buckets = 1 << min(12, bucket_bits(df.sparkSession))
    number = as_number(df, column)
    fractions = [i / buckets for i in range(1, buckets)]
    borders = df.agg(F.percentile_approx(number, fractions, max(10_000, buckets * 4))).first()[0] or []
    inner = sorted({b for b in borders if b == b and abs(b) != float("inf")})
    splits = [float("-inf"), *inner, float("inf")]
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0))
    raw = f"{out}__number"
    cut = Bucketizer(splits=splits, inputCol=raw, outputCol=out, handleInvalid="keep")
    marked = cut.transform(df.withColumn(raw, number)).drop(raw)
    position = F.col(out).cast("int")
    return marked.withColumn(out, F.lit(len(splits)) - position if descending else position)


def _offsets(sizes: DataFrame, bucket: str, within: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Per bucket: sums over all earlier buckets, and totals over all buckets."""
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.col(c) for c in within] + [F.col(bucket)]
    for source, out in sums.items():
        columns.append(F.coalesce(F.sum(source).over(earlier), F.lit(0)).alias(f"{out}__before"))
        columns.append(F.sum(source).over(group).alias(f"{out}__total"))
    return sizes.select(*columns)


def _attach(df: DataFrame, offsets: DataFrame, bucket: str, within: Sequence[str]) -> DataFrame:
    """Equi-join on the bucket and, NULL-safe, on the group columns.

    Every bucket has an offset. The join is an outer one all the same, because an inner
    one makes Spark compute the bucket once more to test it for NULL. Called after the
    window, so that offsets are not shuffled; both sides are grouped by the bucket already.
    """
    if not within:
        return df.join(offsets, bucket, "left")
    renamed = offsets.select(*[F.col(c).alias(f"{c}__right") if c in within else F.col(c) for c in offsets.columns])
    renamed = renamed.withColumnRenamed(bucket, f"{bucket}__right")
    match = F.col(bucket) == F.col(f"{bucket}__right")
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"{c}__right"))
    return df.join(renamed, match, "left").drop(f"{bucket}__right", *[f"{c}__right" for c in within])


def bucketed_rank(
    df: DataFrame,
    out: str,
    *,
    bucket: str,
    order: Sequence[str | Column],
    within: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Add ``out`` = 1, 2, 3 ... in ``order``, separately per ``within`` group.

    ``bucket`` names a column that never decreases along ``order``; it is removed.
    ``total`` optionally names a column for the row count of the group. A group that holds
    most of the table still spreads over all buckets.
    """
    sizes = df.groupBy(*within, bucket).agg(F.count("*").alias("n__rows"))
    offsets = _offsets(sizes, bucket, within, {"n__rows": "n__rank"})
    local = Window.partitionBy(*within, bucket).orderBy(*order)
    placed = df.withColumn("n__local", F.row_number().over(local))
    ranked = _attach(placed, offsets, bucket, within).withColumn(
        out, (F.col("n__local") + F.col("n__rank__before")).cast("long")
    )
    if total:
        ranked = ranked.withColumn(total, F.col("n__rank__total").cast("long"))
    return ranked.drop(bucket, "n__local", "n__rank__before", "n__rank__total")


def running_sums(
    df: DataFrame,
    sums: Mapping[str, str],
    *,
    bucket: str,
    order: Sequence[str | Column],
    totals: bool = False,
) -> DataFrame:
    """Add running sums along ``order``; with ``totals`` also ``<out>_total`` columns."""
    sizes = df.groupBy(bucket).agg(*[F.sum(c).alias(c) for c in sums])
    offsets = _offsets(sizes, bucket, (), sums)
    local = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = df.withColumns({f"{out}__local": F.sum(source).over(local) for source, out in sums.items()})
    joined = _attach(summed, offsets, bucket, ())
    for out in sums.values():
        joined = joined.withColumn(out, F.col(f"{out}__local") + F.col(f"{out}__before"))
        if totals:
            joined = joined.withColumn(f"{out}_total", F.col(f"{out}__total"))
        joined = joined.drop(f"{out}__local", f"{out}__before", f"{out}__total")
    return joined.drop(bucket)


def next_values(
    df: DataFrame, columns: Sequence[str], *, bucket: str, order: Sequence[str | Column], first: Column
) -> DataFrame:
    """Add ``<column>__next``, the value of the next row along ``order``; missing in the last row.

    Neighbours inside a bucket come from a window in the bucket. Across a border the next row is the first one
    of the next bucket that has rows: one row per bucket carries it. ``first`` is the smallest along
    ``order``, as a value that grows with it.
    """
    values = F.struct(*columns)
    heads = df.groupBy(bucket).agg(F.min_by(values, first).alias("head"))
    across = Window.partitionBy(F.lit(0)).orderBy(bucket)  # one row per bucket
    follows = heads.select(bucket, F.lead("head").over(across).alias("border__next"))
    inside = Window.partitionBy(bucket).orderBy(*order)
    placed = df.withColumn("own__next", F.lead(values).over(inside))
    joined = placed.join(follows, bucket, "left").withColumn("any__next", F.coalesce("own__next", "border__next"))
    for c in columns:
        joined = joined.withColumn(f"{c}__next", F.col(f"any__next.{c}"))
    return joined.drop("own__next", "border__next", "any__next")


def hash_rank(
    df: DataFrame,
    out: str,
    key: Sequence[str],
    seed: int,
    *,
    within: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Rank rows in the random but fixed order of a seeded key hash.

    ``key`` must identify a row. The key itself breaks the rare hash ties.
    """
    order = hashing.hash60(key, seed)
    marked = df.withColumn("hash__order", order).withColumn(
        "hash__bucket", hash_bucket(F.col("hash__order"), df.sparkSession)
    )
    return bucketed_rank(
        marked, out, bucket="hash__bucket", order=["hash__order", *key], within=within, total=total
    ).drop("hash__order")


def _stored_in_order(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range-sort and store with the partition and the place in it: the partitions are ordered buckets."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.orderBy(*order).withColumns({"part__id": F.spark_partition_id(), "part__place": place})
    return runtime.store(placed, "ordered")


def ordered_rank(df: DataFrame, out: str, order: Sequence[str | Column]) -> DataFrame:
    """Rank a table in the order of any columns that together identify a row.

    The table is range-sorted and stored; its partitions are the buckets, so a row's rank is
    its place in the partition plus the row counts of the partitions before it.
    """
    stored = _stored_in_order(df, order)
    sizes = stored.groupBy("part__id").agg(F.count("*").alias("n__rows"))
    offsets = _offsets(sizes, "part__id", (), {"n__rows": "n__rank"})
    return (
        stored.join(F.broadcast(offsets), "part__id")  # one row per partition
        .withColumn(out, F.col("part__place") + F.col("n__rank__before") + F.lit(1))
        .drop("part__id", "part__place", "n__rank__before", "n__rank__total")
    )


def ordered_sum(df: DataFrame, column: str, out: str, order: Sequence[str | Column]) -> DataFrame:
    """Running sum of ``column`` in the order of columns that identify a row; like :func:`ordered_rank`."""
    stored = _stored_in_order(df, order)
    return running_sums(stored, {column: out}, bucket="part__id", order=["part__place"]).drop("part__place")

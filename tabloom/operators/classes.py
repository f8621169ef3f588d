"""Class tables: sizes, weights, quotas, names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabloom import runtime
from tabloom.operators import lookup, rank

# Most classes whose table is made on the driver and broadcast; larger ones are made and joined by Spark.
MAX_CLASSES = 10_000

Sizes = list[tuple[object, int]]


@dataclass(frozen=True)
class ClassTable:
    """One row per class; ``few`` if it was made on the driver and so has at most ``MAX_CLASSES`` rows."""

    table: DataFrame
    few: bool


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def class_sizes(df: DataFrame, label: str) -> Sizes | None:
    """Classes in their order with their row counts, a missing label being a class of its own (first).

    None if there are more than ``MAX_CLASSES``.
    """
    rows = class_counts(df, label).orderBy(label).limit(MAX_CLASSES + 1).collect()
    return [(r[label], r["n"]) for r in rows] if len(rows) <= MAX_CLASSES else None


def _few(df: DataFrame, label: str, sizes: Sizes, values: dict[str, tuple[pa.DataType, Sequence]]) -> ClassTable:
    columns = {label: (to_arrow_type(df.schema[label].dataType), [c for c, _ in sizes]), **values}
    rows = [dict(zip(columns, row, strict=True)) for row in zip(*(v for _, v in columns.values()), strict=True)]
    schema = pa.schema([(name, kind) for name, (kind, _) in columns.items()])
    return ClassTable(runtime.local_table(df.sparkSession, rows, schema), True)


def with_values(df: DataFrame, label: str, found: ClassTable) -> DataFrame:
    """Add the columns of a class table of any size, but ``n``, to every row."""
    if not found.few:
        return attach(df, label, runtime.store(found.table, "classes"))
    right = F.broadcast(found.table.drop("n").withColumnRenamed(label, "class__label"))
    return df.join(right, df[label].eqNullSafe(F.col("class__label")), "left").drop("class__label")


def attach(df: DataFrame, label: str, table: DataFrame) -> DataFrame:
    """Add the columns of a class table of any size to every row."""
    return lookup.lookup_join(df, label, table.drop("n"), label, null_safe=True)


def _weights(df: DataFrame, label: str, out: str) -> ClassTable:
    sizes = class_sizes(df, label)
    if sizes is None:
        counts = runtime.store(class_counts(df, label), "classes")
        rows, classes = counts.agg(F.sum("n"), F.count("*")).first()
        weight = F.lit(float(rows)) / (F.lit(classes).cast("double") * F.col("n").cast("double"))
        return ClassTable(counts.withColumn(out, weight), False)
    rows = float(sum(n for _, n in sizes))
    weights = [rows / (len(sizes) * float(n)) for _, n in sizes]
    return _few(df, label, sizes, {"n": (pa.int64(), [n for _, n in sizes]), out: (pa.float64(), weights)})


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Table (label, n, weight) with weight = rows / (classes * n): all classes weigh the same."""
    return _weights(df, label, out).table


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    return with_values(df, label, _weights(df, label, out))


def class_quotas(sizes: Sizes, drawn: int) -> list[int]:
    """Share ``drawn`` rows over the classes in proportion, by largest remainder; earlier classes first."""
    rows = max(sum(n for _, n in sizes), 1)
    quotas = [n * drawn // rows for _, n in sizes]
    by_rest = sorted(range(len(sizes)), key=lambda i: -(sizes[i][1] * drawn % rows))
    for i in by_rest[: drawn - sum(quotas)]:
        quotas[i] += 1
    return quotas


def quotas(df: DataFrame, label: str, drawn: Callable[[int], int], out: str) -> ClassTable:
    """How many rows each class gets if ``drawn(rows)`` of all rows are shared over the classes as in :func:`class_quotas`.

    For many classes the rank of a remainder among all of them decides on the extra row.
    """
    sizes = class_sizes(df, label)
    if sizes is not None:
        return _few(df, label, sizes, {out: (pa.int64(), class_quotas(sizes, drawn(sum(n for _, n in sizes))))})
    counts = runtime.store(class_counts(df, label), "classes")
    rows = counts.agg(F.sum("n")).first()[0]
    number = lambda value: value.cast("decimal(18,0)")
    share, whole = number(F.col("n")) * number(F.lit(drawn(rows))), number(F.lit(rows))
    part = ((share - share % whole) / whole).cast("long")
    parts = runtime.store(counts.select(label, (share % whole).cast("long").alias("rest"), part.alias("part")), "quotas")
    left = drawn(rows) - parts.agg(F.sum("part")).first()[0]
    ranked = rank.ordered_rank(parts, "rest__rank", [F.desc("rest"), F.asc(label)])
    return ClassTable(ranked.select(label, (F.col("part") + (F.col("rest__rank") <= left).cast("long")).alias(out)), False)


def class_starts(sizes: Sizes) -> list[int]:
    """Row count of all earlier classes."""
    return list(accumulate((n for _, n in sizes[:-1]), initial=0)) if sizes else []


def starts(df: DataFrame, label: str, out: str) -> ClassTable:
    """Row count of all classes before each class."""
    sizes = class_sizes(df, label)
    if sizes is not None:
        return _few(df, label, sizes, {out: (pa.int64(), class_starts(sizes))})
    ends = rank.ordered_sum(class_counts(df, label), "n", "class__end", [F.asc(label)])
    return ClassTable(ends.select(label, (F.col("class__end") - F.col("n")).cast("long").alias(out)), False)


def category_index(df: DataFrame, column: str, out: str = "label") -> DataFrame:
    """Stored-size table (column, n, out) numbering the values of ``column`` from 0.

    Most frequent first, ties in alphabetical order; missing values get no number.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return rank.ordered_rank(counts, out, [F.desc("n"), F.asc(column)]).withColumn(out, F.col(out) - 1)


def index_names(df: DataFrame, index: str, table: DataFrame, number: str, name: str, out: str) -> DataFrame:
    """Replace class numbers by names: add ``out`` from the (name, n, number) table."""
    names = table.select(F.col(number).cast("double").alias("index__number"), F.col(name).alias(out))
    marked = df.withColumn("index__wanted", F.col(index).cast("double"))
    return lookup.lookup_join(marked, "index__wanted", names, "index__number").drop("index__wanted")


def class_count(df: DataFrame, label: str) -> DataFrame:
    """Number of classes a model over labels 0, 1, 2 ... needs, present or not: largest label + 1."""
    return df.agg((F.max(label).cast("long") + 1).alias("classes"))

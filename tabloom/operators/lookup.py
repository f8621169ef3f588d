"""Joining a skewed column with a lookup table of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom import runtime


def _octave(freq: str) -> Column:
    return F.floor(F.log2(F.greatest(freq, F.lit(1))))


def frequent_floor(table: DataFrame, freq: str) -> int | None:
    """Smallest power-of-two exponent at which the entries that are at least so frequent fit a broadcast.

    Entries are measured per power of two of their frequency, which gives at most 64 groups.
    """
    octaves = (
        table.groupBy(_octave(freq).alias("octave"))
        .agg(F.count("*").alias("entries"), F.sum(runtime.row_bytes(table)).alias("size"))
        .collect()
    )
    entries = size = 0
    floor = None
    for row in sorted(octaves, key=lambda r: -r["octave"]):
        entries, size = entries + row["entries"], size + row["size"]
        if not runtime.fits_broadcast(entries, size):
            break
        floor = row["octave"]
    return floor


def lookup_join(
    df: DataFrame,
    column: str,
    table: DataFrame,
    key: str,
    *,
    null_safe: bool = False,
    counts: str | None = None,
) -> DataFrame:
    """Left-join ``table``, which holds one row per ``key``, on ``column`` of any skew.

    A table measured to be small is broadcast; give a stored one, as it is read twice. Of a
    larger table only the entries that ``df`` uses are kept, together with how often it
    uses them. The frequent ones are broadcast, and only rows with rare values are
    shuffled, so no key of the shuffle is hot, be it known to the table or not.

    ``counts`` names a column of ``table`` that holds how often ``df`` uses each key. It is not part of the
    result, and spares the pass that counts the uses; every value of ``df`` but NULL should be in the table then.
    """
    values = [c for c in table.columns if c not in (key, counts)]
    rows, size = table.agg(F.count("*"), F.sum(runtime.row_bytes(table.select(key, *values)))).first()
    right = table.select(F.col(key).alias("lookup__key"), *values)

    def same(left: DataFrame) -> Column:
        a, b = left[column], F.col("lookup__key")
        return a.eqNullSafe(b) if null_safe else a == b

    if runtime.fits_broadcast(rows, size):
        return df.join(F.broadcast(right), same(df), "left").drop("lookup__key")

    if counts and not null_safe:
        floor = frequent_floor(table, counts)
        if floor is None:
            return df.join(right, same(df), "left").drop("lookup__key")
        named = F.col(key).alias("lookup__key")
        often = _octave(counts) >= F.lit(floor)
        head, tail = F.broadcast(table.filter(often).select(named, *values)), table.filter(~often).select(named, *values)
        # a missing value finds nothing; it stays where it is, as all of them would meet in one task
        common = df.join(head, same(df), "left").filter(F.col("lookup__key").isNotNull() | F.col(column).isNull())
        rest = df.filter(F.col(column).isNotNull())
        rest = rest.join(head.select("lookup__key"), same(rest), "left_anti")
        return common.unionByName(rest.join(tail, same(rest), "left")).drop("lookup__key")

    used = df.groupBy(column).agg(F.count("*").alias("lookup__n"))
    found = runtime.store(
        used.join(right, same(used), "left").select(F.col(column).alias("lookup__used"), "lookup__n", *values), "found"
    )
    match = F.col(column).eqNullSafe(F.col("lookup__used"))
    floor = frequent_floor(found, "lookup__n")
    if floor is None:
        return df.join(found.drop("lookup__n"), match).drop("lookup__used")
    frequent = _octave("lookup__n") >= F.lit(floor)
    head = F.broadcast(found.filter(frequent).drop("lookup__n"))
    common = df.join(head, match)
    rest = df.join(head.select("lookup__used"), match, "left_anti")
    rare = rest.join(found.filter(~frequent).drop("lookup__n"), match)
    return common.unionByName(rare).drop("lookup__used")

"""Reading and writing tables and line files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom import runtime


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


# Column types that a CSV value can have, narrowest first, and the form a value of each has.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_KINDS = (
    (T.IntegerType(), r"^\s*[+-]?[0-9]+\s*$"),
    (T.LongType(), r"^\s*[+-]?[0-9]+\s*$"),
    (T.DoubleType(), _NUMBER),
    (T.BooleanType(), r"(?i)^\s*(true|false)\s*$"),
    (T.TimestampType(), r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"),
)


def inferred_schema(spark: SparkSession, path: str) -> T.StructType:
    """Names from the header line of a CSV, and per column the narrowest type that all of its values have.

    One aggregation over all rows counts, per column and type, the values that do not fit it. Missing values fit every type; a
    column without any value is text.
    """
    plain = spark.read.csv(path, header=True, escape='"')
    names = plain.columns
    plain = plain.toDF(*[f"c{i}" for i in range(len(names))])

    def misfits(name: str, kind: T.DataType, form: str) -> Column:
        fits = F.col(name).rlike(form) & F.col(name).try_cast(kind).isNotNull()
        return F.count_if(F.col(name).isNotNull() & ~fits)

    facts = [F.struct(F.count(c), *[misfits(c, *kind) for kind in _KINDS]).alias(c) for c in plain.columns]
    found = plain.agg(*facts).first() if names else ()

    def narrowest(filled: int, *wrong: int) -> T.DataType:
        fitting = (kind for (kind, _), n in zip(_KINDS, wrong, strict=True) if filled and not n)
        return next(fitting, T.StringType())

    return T.StructType([T.StructField(name, narrowest(*counts)) for name, counts in zip(names, found, strict=True)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line and a declared schema, or an inferred one; a malformed row is an error."""
    schema = inferred_schema(spark, path) if schema is None else schema
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", escape='"')


def read_first_field(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """First field of each row of a headerless CSV, as column ``text``; blank lines are skipped."""
    schema = T.StructType([T.StructField("text", T.StringType())])
    return spark.read.schema(schema).csv(
        path, header=False, mode="PERMISSIVE", escape='"', multiLine=multi_line, enforceSchema=True
    )


def number_rows(scan: DataFrame, out: str = "row") -> DataFrame:
    """Number the rows of a file scan from 0, by file name, split start and order inside the split.

    The row count of every split is taken in a first scan; nothing is shuffled but those
    counts. Prefer a key column where the data has one.
    """
    columns = scan.columns
    rows = scan.select(
        *columns,
        F.col("_metadata.file_path").alias("file__path"),
        F.col("_metadata.file_block_start").alias("file__start"),
        F.monotonically_increasing_id().alias("file__seen"),
    )
    # hashing all columns keeps them in the counting scan, so both scans parse the same rows
    splits = runtime.store(
        rows.groupBy("file__path", "file__start").agg(
            F.count("*").alias("n"), F.min("file__seen").alias("first"), F.max(F.xxhash64(*columns)).alias("kept")
        ), "splits"
    )
    in_order = Window.partitionBy(F.lit(0)).orderBy("file__path", "file__start")
    earlier = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select(
        "file__path", "file__start", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("file__offset")
    )
    if runtime.fits_broadcast(*splits.agg(F.count("*"), F.sum(runtime.row_bytes(splits))).first()):
        offsets = F.broadcast(offsets)
    # a split missing here means the second scan cut the files elsewhere: never lose its rows silently
    changed = F.raise_error(F.lit("file splits changed between the two scans")).cast("long")
    return rows.join(offsets, ["file__path", "file__start"], "left").select(
        (F.coalesce("file__offset", changed) + F.col("file__seen")).alias(out), *columns
    )


def read_numbered_lines(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """First fields with the position of each row in column ``row``, for files paired by position."""
    return number_rows(read_first_field(spark, path, multi_line=multi_line))


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "errorifexists", **options) -> None:
    """Write any result table."""
    df.write.format(fmt).mode(mode).options(**options).save(path)

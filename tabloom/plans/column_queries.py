"""Queries of the single-table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom import runtime
from tabloom.functions import calendar, numeric
from tabloom.operators import columns, profile, reshape
from tabloom.plans.catalog import Catalog
from tabloom.plans.standins import DOCUMENT_FEATURES, LINES_SQL, SENSOR_SQL, STUDY_SQL, labelled_documents, lines, table
from tabloom.plans.standins import sensor as sensor_table
from tabloom.sources import tables

CATALOG = Catalog()

_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@CATALOG.query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def parquet_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Scan with a declared schema; only the used columns are read."""
    events = tables.read_parquet(spark, f"{folder}/events.parquet", _EVENT_SCHEMA)
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value"))


@CATALOG.query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the customers as CSV with a header and read them back by a declared schema."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    path = runtime.scratch_path(spark, "customer")
    tables.write_table(customers, path, fmt="csv", header=True)
    return tables.read_csv(spark, path, customers.schema)


@CATALOG.query(
    """
    WITH long AS (
      UNPIVOT (SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
        printf('%.2f', c_acctbal) AS c_acctbal, c_mktsegment, (c_custkey::BIGINT * 3000000000)::VARCHAR AS wide,
        (c_acctbal > 0)::VARCHAR AS positive FROM customer)
      ON * INTO NAME name VALUE value
    )
    SELECT name, count(*) AS n, CASE
      WHEN bool_and(regexp_full_match(value, '[+-]?[0-9]+')) THEN
        CASE WHEN bool_and(try_cast(value AS INTEGER) IS NOT NULL) THEN 'int' ELSE 'bigint' END
      WHEN bool_and(regexp_full_match(value, '[+-]?[0-9]+[.][0-9]+')) THEN 'double'
      WHEN bool_and(value IN ('true', 'false')) THEN 'boolean' ELSE 'string' END AS type
    FROM long GROUP BY 1
    """
)
def csv_inferred_types(spark: SparkSession, folder: str) -> DataFrame:
    """Write the customers as CSV, read them without a schema and report the type of every column."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment",
        (F.col("c_custkey").cast("long") * 3_000_000_000).alias("wide"), (F.col("c_acctbal") > 0).alias("positive"),
    )
    path = runtime.scratch_path(spark, "inferred")
    tables.write_table(customers, path, fmt="csv", header=True)
    typed = tables.read_csv(spark, path)
    facts = [F.struct(F.lit(c).alias("name"), F.count(c).alias("n"), F.lit(t).alias("type")) for c, t in typed.dtypes]
    return typed.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


@CATALOG.query("SELECT o_orderkey, o_totalprice FROM orders")
def result_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Write a result as Parquet and read it back."""
    path = runtime.scratch_path(spark, "orders")
    tables.write_table(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), path)
    return tables.read_parquet(spark, path)


@CATALOG.query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def table_preview(spark: SparkSession, folder: str) -> DataFrame:
    """First rows of a sorted table."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return tables.preview(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"), 20)


@CATALOG.query(
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS month, CAST(hour(o_orderdate) AS INT) AS hour,
         CAST(dayofweek(o_orderdate) + 1 AS INT) AS weekday, dayname(o_orderdate) AS weekday_name,
         CAST(isodow(o_orderdate) AS INT) AS weekday_order,
         CAST(dayofweek(o_orderdate) IN (0, 6) AS INT) AS is_weekend,
         CAST(month(o_orderdate) NOT IN (4, 6, 9) AS INT) AS listed_long,
         CAST(day(last_day(o_orderdate)) = 31 AS INT) AS exact_long
       FROM orders"""
)
def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    """All calendar columns of the orders."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    derived = columns.derive(
        orders,
        {
            "month": calendar.month_of_year("o_orderdate"),
            "hour": calendar.hour_of_day("o_orderdate"),
            "weekday": calendar.day_of_week("o_orderdate"),
            "weekday_name": calendar.day_name("o_orderdate"),
            "weekday_order": calendar.day_position("o_orderdate"),
            "is_weekend": calendar.weekend_flag("o_orderdate"),
            "listed_long": calendar.long_month_flag("o_orderdate"),
            "exact_long": calendar.long_month_flag("o_orderdate", exact=True),
        },
    )
    return columns.drop_columns(derived, ["o_orderdate"])


@CATALOG.query(
    f"""WITH {SENSOR_SQL} SELECT strftime("timestamp", '%Y-%m-%d %H') AS hour_key,
          round(power_elevator_01 + power_elevator_02 + power_ventilation, 8) AS total FROM sensor"""
)
def sum_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Sums over columns with gaps: one gap makes the sum missing."""
    wide = sensor_table(spark, folder)
    summed = columns.sum_columns(wide, ["power_elevator_01", "power_elevator_02", "power_ventilation"], "total")
    return summed.select(
        F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_key"), F.round("total", 8).alias("total")
    )


@CATALOG.query(
    f"""WITH {SENSOR_SQL} SELECT strftime("timestamp", '%Y-%m-%d %H') AS hour_key FROM sensor
        WHERE temperature IS NOT NULL AND power_ventilation IS NOT NULL AND power_solar_plant IS NOT NULL"""
)
def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Rows complete in three columns."""
    wide = sensor_table(spark, folder)
    kept = columns.drop_missing(wide, ["temperature", "power_ventilation", "power_solar_plant"])
    return kept.select(F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_key"))


@CATALOG.query(
    """SELECT l_orderkey, l_quantity AS measured, 'quantity' AS kind FROM lineitem"""
)
def rename_and_constant(spark: SparkSession, folder: str) -> DataFrame:
    """Copy a column, add a constant, drop the original."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    marked = columns.constant(columns.copy_column(items, "l_quantity", "measured"), "kind", "quantity")
    return columns.drop_columns(marked, ["l_quantity"])


@CATALOG.query(
    """SELECT l_returnflag, round(sum(l_extendedprice) / sum(l_quantity), 6) AS unit_price,
         CAST(sum(CASE WHEN l_returnflag = 'R' OR l_linestatus IN ('F') THEN 1 ELSE 0 END) AS BIGINT) AS hits
       FROM lineitem GROUP BY 1"""
)
def guarded_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Arithmetic and predicates inside aggregates."""
    hit = (F.col("l_returnflag") == "R") | F.col("l_linestatus").isin("F")
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.round(numeric.ratio(F.sum("l_extendedprice"), F.sum("l_quantity")), 6).alias("unit_price"),
            F.sum(F.when(hit, 1).otherwise(0)).alias("hits"),
        )
    )


@CATALOG.query("SELECT DISTINCT event_type, CAST(hour(ts) AS INT) AS hour FROM events")
def distinct_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Label pairs that occur."""
    events = table(spark, folder, "events").withColumn("hour", F.hour("ts"))
    return reshape.distinct_rows(events, ["event_type", "hour"])


@CATALOG.query(
    """SELECT kind, count(*) AS n, round(sum(amount), 2) AS total FROM (
         SELECT 'customer' AS kind, c_acctbal AS amount FROM customer
         UNION ALL SELECT 'supplier', s_acctbal FROM supplier
         UNION ALL SELECT 'customer', c_acctbal FROM customer) GROUP BY 1"""
)
def stacked_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of three tables, repeats kept."""
    customers = columns.constant(table(spark, folder, "customer").select(F.col("c_acctbal").alias("amount")), "kind", "customer")
    suppliers = columns.constant(table(spark, folder, "supplier").select(F.col("s_acctbal").alias("amount")), "kind", "supplier")
    return (
        reshape.stack_tables([customers, suppliers, customers])
        .groupBy("kind")
        .agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"))
    )


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@CATALOG.query(
    """SELECT measure, count(*) AS n, round(sum(amount), 2) AS total FROM (
         SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS measure,
           unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS amount FROM lineitem) GROUP BY 1"""
)
def melt_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Four measures of every line item in long form."""
    items = table(spark, folder, "lineitem")
    long = reshape.melt_groups(items, {m: F.col(m) for m in _MEASURES}, ["l_orderkey"], name="measure", value="amount")
    return long.groupBy("measure").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"))


def _describe_sql(source: str, names: tuple[str, ...]) -> str:
    parts = [
        f"""SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
              round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1,
              round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3,
              round(max({c}), 6) AS max FROM {source}"""
        for c in names
    ]
    return " UNION ALL ".join(parts)


_SUMMARY = ("mean", "std", "min", "q1", "median", "q3", "max")


def _rounded(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


@CATALOG.query(_describe_sql("lineitem", _MEASURES))
def describe_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the line item measures with exact quartiles."""
    return _rounded(profile.describe(table(spark, folder, "lineitem"), _MEASURES), _SUMMARY)


@CATALOG.query(f"WITH {STUDY_SQL} " + _describe_sql("study", (*DOCUMENT_FEATURES, "quality")))
def describe_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the document features and their label."""
    documents = labelled_documents(spark, folder).persist()
    try:
        return _rounded(profile.describe(documents, (*DOCUMENT_FEATURES, "quality")), _SUMMARY)
    finally:
        documents.unpersist()


def _box_sql(source: str, names: tuple[str, ...]) -> str:
    parts = [
        f"""SELECT '{c}' AS feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
              round(least(min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)), q1), 6) AS whisker_low,
              round(greatest(max({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)), q3), 6) AS whisker_high,
              count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
            FROM {source}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
              quantile_cont({c}, 0.75) AS q3 FROM {source}) GROUP BY q1, median, q3"""
        for c in names
    ]
    return " UNION ALL ".join(parts)


@CATALOG.query(_box_sql("orders", ("o_totalprice",)) + " UNION ALL " + _box_sql("orders", ("o_custkey",)))
def box_stats_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles, whiskers and outliers of two order columns."""
    stats = profile.box_stats(table(spark, folder, "orders"), ("o_totalprice", "o_custkey"))
    return _rounded(stats, ("q1", "median", "q3", "whisker_low", "whisker_high"))


@CATALOG.query(f"WITH {STUDY_SQL} " + _box_sql("study", DOCUMENT_FEATURES))
def box_stats_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles, whiskers and outliers of the document features."""
    documents = labelled_documents(spark, folder).persist()
    try:
        stats = profile.box_stats(documents, DOCUMENT_FEATURES)
    finally:
        documents.unpersist()
    return _rounded(stats, ("q1", "median", "q3", "whisker_low", "whisker_high"))


@CATALOG.query(
    f"""WITH {LINES_SQL} SELECT line_id, l_extendedprice FROM lines ORDER BY l_extendedprice DESC, line_id LIMIT 10"""
)
def top_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The ten dearest line items."""
    items = lines(spark, folder).select("line_id", "l_extendedprice")
    return columns.top_rows(items, [F.desc("l_extendedprice"), "line_id"], 10)

"""The provided tables, brought into the shapes the plans work on.

Each stand-in comes with the SQL text that describes the same table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.functions import numeric, text
from tabloom.plans.patient import Study
from tabloom.sources import tables


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, os.path.join(folder, f"{name}.parquet"))


# Which events feed which sensor column: (event type, measured field).
_SENSOR_FEEDS = {
    "temperature": ("view", "value"),
    "humidity": ("view", "k"),
    "power_water_cooling_01": ("click", "value"),
    "power_water_cooling_02": ("click", "k"),
    "power_ventilation": ("signup", "value"),
    "power_elevator_01": ("purchase", "value"),
    "power_elevator_02": ("purchase", "k"),
    "power_ev_charging": ("error", "value"),
    "power_solar_plant": ("error", "k"),
}


def sensor(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly means of the events, one column per feed, with gaps where a type is absent."""
    k = F.get_json_object("props", "$.k").cast("double")
    measured = {"value": F.col("value"), "k": k}
    means = [
        F.avg(F.when(F.col("event_type") == kind, measured[field])).alias(name)
        for name, (kind, field) in _SENSOR_FEEDS.items()
    ]
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")
    return table(spark, folder, "events").groupBy(hour).agg(*means)


SENSOR_SQL = """sensor AS (
  SELECT date_trunc('hour', ts) AS "timestamp",
    avg(value) FILTER (event_type = 'view') AS temperature,
    avg(k) FILTER (event_type = 'view') AS humidity,
    avg(value) FILTER (event_type = 'click') AS power_water_cooling_01,
    avg(k) FILTER (event_type = 'click') AS power_water_cooling_02,
    avg(value) FILTER (event_type = 'signup') AS power_ventilation,
    avg(value) FILTER (event_type = 'purchase') AS power_elevator_01,
    avg(k) FILTER (event_type = 'purchase') AS power_elevator_02,
    avg(value) FILTER (event_type = 'error') AS power_ev_charging,
    avg(k) FILTER (event_type = 'error') AS power_solar_plant
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
  GROUP BY 1)"""


def daily_sensor(spark: SparkSession, folder: str) -> DataFrame:
    """Daily means of the line items in the shape of the sensor table; it covers all months."""
    fields = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    means = [
        F.avg(F.when(F.pmod("l_suppkey", F.lit(3)) == i % 3, F.col(fields[i % 4]))).alias(name)
        for i, name in enumerate(_SENSOR_FEEDS)
    ]
    day = F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp")
    return table(spark, folder, "lineitem").groupBy(day).agg(*means)


DOCUMENT_FEATURES = ("n_chars", "n_tokens", "distinct_ratio", "mean_token_length", "n_lines")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric features of the labelled documents and the imbalanced 0/1 label ``quality``.

    Features are computed before the join, so it moves six numbers per document, not texts.
    """
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    docs = table(spark, folder, "documents").join(labels.select("doc_id"), "doc_id", "left_semi")
    docs = runtime.spread(docs.select("doc_id", "text", "n_chars"), "doc_id").withColumn("tokens", text.tokenize("text"))
    words = F.size("tokens").cast("double")
    letters = F.length(F.array_join("tokens", "")).cast("double")
    features = docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        words.alias("n_tokens"),
        numeric.ratio(F.size(F.array_distinct("tokens")), words, 0.0).alias("distinct_ratio"),
        numeric.ratio(letters, words, 0.0).alias("mean_token_length"),
        (F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("double").alias("n_lines"),
    )
    return features.join(labels, "doc_id")


def study(spark: SparkSession, folder: str) -> Study:
    return Study(labelled_documents(spark, folder), ("doc_id",), DOCUMENT_FEATURES, "quality")


def sql_tokens(column: str) -> str:
    """The tokenizer as SQL."""
    characters = text.DELETED_CHARACTERS.replace("\t", "").replace("\n", "")
    deleted = f"'{characters}' || chr(9) || chr(10)"
    return (
        f"list_filter(regexp_split_to_array(translate(lower({column}), {deleted}, ''), '\\s+'), lambda w: w <> '')"
    )


STUDY_SQL = f"""study AS (
  SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, n AS n_tokens,
    CASE WHEN n = 0 THEN 0.0 ELSE len(list_distinct(w)) / n END AS distinct_ratio,
    CASE WHEN n = 0 THEN 0.0 ELSE length(array_to_string(w, '')) / n END AS mean_token_length,
    CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) AS n_lines, quality
  FROM (SELECT doc_id, text, n_chars, quality, w, CAST(len(w) AS DOUBLE) AS n
        FROM (SELECT d.doc_id, d.text, d.n_chars, l.quality, {sql_tokens("d.text")} AS w
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id)))"""


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """User turns paired with the assistant turn that follows: (pair_id, source, target).

    The pair is found by an equi-join on (conversation, turn), which spreads even a
    conversation that holds much of the table.
    """
    talk = table(spark, folder, "conversations")
    asked = talk.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source"))
    answered = talk.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("pair_id"), "source", "target"
    )


TURNS_SQL = """turns AS (
  SELECT concat_ws('-', q.conv_id, q.turn) AS pair_id, q.text AS source, a.text AS target
  FROM conversations q JOIN conversations a
    ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
  WHERE q.role = 'user' AND a.role = 'assistant')"""


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a unique key in one column."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, folder, "lineitem").withColumn("line_id", key)


LINES_SQL = """lines AS (
  SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_id FROM lineitem)"""

"""Queries of the sensor plans on the hourly event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.functions import calendar, numeric
from tabloom.operators import classes, columns, metrics, models, profile, split
from tabloom.plans import sensor
from tabloom.plans.catalog import Catalog
from tabloom.plans.standins import SENSOR_SQL, daily_sensor, lines, table
from tabloom.plans.standins import sensor as sensor_table

CATALOG = Catalog()

def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly table, aggregated once for all passes of a fit."""
    return runtime.store(sensor_table(spark, folder), "hourly")


def _rounded(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: F.round(c, 8) for c in names})


@CATALOG.query(
    """SELECT dayname(ts) AS weekday,
         sum(CASE WHEN CAST(dayofweek(ts) IN (0, 6) AS INT) = CAST(value > 20 AS INT) THEN 1 ELSE 0 END)
           / count(*) * 100.0 AS accuracy
       FROM events WHERE value IS NOT NULL AND ts IS NOT NULL GROUP BY 1"""
)
def accuracy_by_weekday(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of a fixed weekend rule per weekday, Monday first."""
    events = columns.drop_missing(table(spark, folder, "events").select("ts", "value"))
    ruled = columns.derive(
        events,
        {
            "weekday_name": calendar.day_name("ts"),
            "weekday_order": calendar.day_position("ts"),
            "is_weekend": calendar.weekend_flag("ts"),
            "prediction": F.when(F.col("value") > 20, 1.0).otherwise(0.0),
        },
    )
    return sensor.weekend_report(ruled, digits=None)


@CATALOG.query(
    f"""WITH {SENSOR_SQL} SELECT strftime("timestamp", '%Y-%m-%d %H') AS hour_key,
          round(temperature, 8) AS temperature, round(humidity, 8) AS humidity,
          round(power_water_cooling_01, 8) AS power_water_cooling_01,
          round(power_solar_plant, 8) AS power_solar_plant FROM sensor"""
)
def hourly_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The wide hourly table."""
    names = ("temperature", "humidity", "power_water_cooling_01", "power_solar_plant")
    wide = sensor_table(spark, folder).select(F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_key"), *names)
    return _rounded(wide, names)


@CATALOG.query(
    f"""WITH {SENSOR_SQL} SELECT strftime("timestamp", '%Y-%m-%d %H') AS hour_key,
          CAST(hour("timestamp") AS INT) AS hour, round(temperature, 8) AS temperature,
          round(power_water_cooling_01 + power_water_cooling_02 + power_ventilation + power_elevator_01
            + power_elevator_02 + power_ev_charging, 8) AS total_power_consumption
        FROM sensor WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND power_solar_plant IS NOT NULL
          AND power_water_cooling_01 IS NOT NULL AND power_water_cooling_02 IS NOT NULL
          AND power_ventilation IS NOT NULL AND power_elevator_01 IS NOT NULL
          AND power_elevator_02 IS NOT NULL AND power_ev_charging IS NOT NULL"""
)
def hour_features(spark: SparkSession, folder: str) -> DataFrame:
    """Label hour, total consumption with missing addends, incomplete rows removed."""
    df = sensor.hour_table(sensor_table(spark, folder)).select(
        F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_key"), "hour", "temperature", "total_power_consumption"
    )
    return _rounded(df, ("temperature", "total_power_consumption"))


@CATALOG.query(
    f"""WITH {SENSOR_SQL} SELECT strftime("timestamp", '%Y-%m-%d %H') AS hour_key,
          CAST(dayofweek("timestamp") + 1 AS INT) AS weekday, dayname("timestamp") AS weekday_name,
          CAST(isodow("timestamp") AS INT) AS weekday_order,
          CAST(dayofweek("timestamp") IN (0, 6) AS INT) AS is_weekend,
          round(power_water_cooling_01 + power_water_cooling_02, 8) AS total_water_cooling,
          round(power_elevator_01 + power_elevator_02, 8) AS total_elevator
        FROM sensor WHERE power_water_cooling_01 + power_water_cooling_02 IS NOT NULL
          AND power_ventilation IS NOT NULL AND power_elevator_01 + power_elevator_02 IS NOT NULL
          AND power_ev_charging IS NOT NULL AND power_solar_plant IS NOT NULL"""
)
def weekend_features(spark: SparkSession, folder: str) -> DataFrame:
    """Weekday columns, weekend flag and grouped power sums."""
    df = sensor.weekend_table(sensor_table(spark, folder)).select(
        F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_key"),
        "weekday",
        "weekday_name",
        "weekday_order",
        "is_weekend",
        "total_water_cooling",
        "total_elevator",
    )
    return _rounded(df, ("total_water_cooling", "total_elevator"))


_DEVICE_SQL = f"""WITH {SENSOR_SQL}, device AS (
  SELECT * FROM (
    SELECT "timestamp", temperature, humidity, 'elevator' AS device_type,
      power_elevator_01 + power_elevator_02 AS power_value FROM sensor
    UNION ALL SELECT "timestamp", temperature, humidity, 'ev_charging', power_ev_charging FROM sensor
    UNION ALL SELECT "timestamp", temperature, humidity, 'solar_plant', power_solar_plant FROM sensor
    UNION ALL SELECT "timestamp", temperature, humidity, 'ventilation', power_ventilation FROM sensor
    UNION ALL SELECT "timestamp", temperature, humidity, 'water_cooling',
      power_water_cooling_01 + power_water_cooling_02 FROM sensor)
  WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND power_value IS NOT NULL)"""


@CATALOG.query(
    f"""{_DEVICE_SQL} SELECT strftime("timestamp", '%Y-%m-%d %H') AS hour_key,
          CAST(hour("timestamp") AS INT) AS hour, CAST(month("timestamp") AS INT) AS month, device_type,
          round(power_value, 8) AS power_value FROM device"""
)
def melt_devices(spark: SparkSession, folder: str) -> DataFrame:
    """One row per reading and device type, from one scan."""
    df = sensor.device_table(sensor_table(spark, folder)).select(
        F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_key"), "hour", "month", "device_type", "power_value"
    )
    return _rounded(df, ("power_value",))


@CATALOG.query(
    f"""{_DEVICE_SQL} SELECT device_type, count(*) AS n,
          row_number() OVER (ORDER BY count(*) DESC, device_type) - 1 AS label FROM device GROUP BY 1"""
)
def label_index(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of the device types, most frequent first."""
    return classes.category_index(sensor.device_table(sensor_table(spark, folder)), "device_type")


@CATALOG.query(
    f"""{_DEVICE_SQL}, idx AS (
          SELECT device_type, row_number() OVER (ORDER BY count(*) DESC, device_type) - 1 AS label
          FROM device GROUP BY 1),
        ruled AS (
          SELECT d.device_type, i.label, CAST(floor(d.power_value) AS BIGINT) % 5 AS prediction
          FROM device d JOIN idx i ON d.device_type = i.device_type)
        SELECT r.device_type, p.device_type AS predicted_type, count(*) AS n
        FROM ruled r LEFT JOIN idx p ON p.label = r.prediction GROUP BY 1, 2"""
)
def class_names(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted class numbers turned back into names, counted per actual name."""
    devices = sensor.device_table(sensor_table(spark, folder))
    index = classes.category_index(devices, "device_type")
    ruled = devices.withColumn("prediction", F.floor("power_value") % 5)
    named = classes.index_names(ruled, "prediction", index, "label", "device_type", "predicted_type")
    return named.groupBy("device_type", "predicted_type").agg(F.count("*").alias("n"))


@CATALOG.query(
    f"""{_DEVICE_SQL}, idx AS (
          SELECT device_type, row_number() OVER (ORDER BY count(*) DESC, device_type) - 1 AS label
          FROM device GROUP BY 1)
        SELECT d.device_type, round(sum(CASE WHEN i.label = CAST(floor(d.power_value) AS BIGINT) % 5
            THEN 1 ELSE 0 END) / count(*) * 100.0, 8) AS accuracy
        FROM device d JOIN idx i ON d.device_type = i.device_type GROUP BY 1"""
)
def accuracy_by_device(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of a fixed rule per device type, best first."""
    devices = sensor.device_table(sensor_table(spark, folder))
    labelled = classes.attach(devices, "device_type", classes.category_index(devices, "device_type"))
    ruled = labelled.withColumn("prediction", F.floor("power_value") % 5)
    return _rounded(sensor.device_report(ruled, digits=None), ("accuracy",))


_TOTALS_SQL = f"""WITH {SENSOR_SQL}, totals AS (
  SELECT *, power_water_cooling_01 + power_water_cooling_02 AS total_water_cooling,
    power_elevator_01 + power_elevator_02 AS total_elevator FROM sensor),
spreads AS (
  SELECT 1 AS pos, 'total_water_cooling' AS feature, stddev_pop(total_water_cooling) AS spread FROM totals
  UNION ALL SELECT 2, 'power_ventilation', stddev_pop(power_ventilation) FROM totals
  UNION ALL SELECT 3, 'total_elevator', stddev_pop(total_elevator) FROM totals
  UNION ALL SELECT 4, 'power_ev_charging', stddev_pop(power_ev_charging) FROM totals
  UNION ALL SELECT 5, 'power_solar_plant', stddev_pop(power_solar_plant) FROM totals),
ordered AS (SELECT *, row_number() OVER (ORDER BY spread DESC, pos) AS r FROM spreads)"""


@CATALOG.query(f"{_TOTALS_SQL} SELECT feature, round(spread, 8) AS spread FROM ordered")
def column_spreads(spark: SparkSession, folder: str) -> DataFrame:
    """Spread of all power columns in one pass."""
    totals = sensor.with_totals(sensor_table(spark, folder))
    return _rounded(profile.spreads(totals, sensor.POWER_FEATURES), ("spread",))


@CATALOG.query(f"{_TOTALS_SQL} SELECT feature, round(spread, 8) AS spread FROM ordered WHERE r <= 2")
def top_spread_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The two power columns that vary most."""
    totals = sensor.with_totals(sensor_table(spark, folder))
    return _rounded(profile.top_spread_table(totals, sensor.POWER_FEATURES, 2), ("spread",))


def _pick(rank: int) -> str:
    cases = " ".join(f"WHEN '{c}' THEN {c}" for c in sensor.POWER_FEATURES)
    return f"CASE (SELECT feature FROM ordered WHERE r = {rank}) {cases} END"


@CATALOG.query(
    f"""{_TOTALS_SQL} SELECT * FROM (
          SELECT strftime("timestamp", '%Y-%m-%d %H') AS hour_key, round(temperature, 8) AS temperature,
            round(humidity, 8) AS humidity, round({_pick(1)}, 8) AS first_power, round({_pick(2)}, 8) AS second_power,
            CASE WHEN month("timestamp") IN (4, 6, 9) THEN 0 ELSE 1 END AS label
          FROM totals WHERE "timestamp" IS NOT NULL)
        WHERE temperature IS NOT NULL AND humidity IS NOT NULL
          AND first_power IS NOT NULL AND second_power IS NOT NULL"""
)
def month_length_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features chosen by the data and the length-of-month label."""
    df, features = sensor.month_table(sensor_table(spark, folder))
    named = df.select(
        F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_key"),
        "temperature",
        "humidity",
        F.col(features[2]).alias("first_power"),
        F.col(features[3]).alias("second_power"),
        "label",
    )
    return _rounded(named, ("temperature", "humidity", "first_power", "second_power"))


@CATALOG.query(
    """SELECT round(avg(CASE WHEN p = h THEN 1.0 ELSE 0.0 END), 8) AS accuracy,
         round(avg(least(abs(p - h), 24 - abs(p - h))), 8) AS mean_error
       FROM (SELECT hour(ts) AS h, floor(value * 7) % 24 AS p FROM events)"""
)
def cyclic_error(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy and mean circular distance of a fixed hour rule."""
    ruled = table(spark, folder, "events").select(
        calendar.hour_of_day("ts").alias("hour"), (F.floor(F.col("value") * 7) % 24).alias("prediction")
    )
    return _rounded(sensor.hour_report(ruled), ("accuracy", "mean_error"))


@CATALOG.query(
    """SELECT event_type, round(avg(least(abs(p - h), 24 - abs(p - h))), 8) AS mean_distance
       FROM (SELECT event_type, hour(ts) AS h, floor(value * 7) % 24 AS p FROM events) GROUP BY 1"""
)
def cyclic_distance_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Mean circular distance per event type."""
    gap = numeric.cyclic_distance(F.hour("ts"), F.floor(F.col("value") * 7) % 24, 24)
    return table(spark, folder, "events").groupBy("event_type").agg(F.round(F.avg(gap), 8).alias("mean_distance"))


@CATALOG.query(
    """WITH ruled AS (
         SELECT CAST(month(o_orderdate) NOT IN (4, 6, 9) AS INT) AS y, CAST(o_totalprice > 150000 AS INT) AS p
         FROM orders),
       c AS (SELECT y AS k FROM ruled UNION SELECT p FROM ruled),
       per AS (
         SELECT k, (SELECT count(*) FROM ruled WHERE y = k) AS actual, (SELECT count(*) FROM ruled WHERE p = k) AS given,
           (SELECT count(*) FROM ruled WHERE p = k AND y = k) AS hits FROM c)
       SELECT 'accuracy' AS metric, round(sum(hits) / sum(actual), 8) AS value FROM per
       UNION ALL
       SELECT 'weighted_precision',
         round(sum(CASE WHEN given = 0 THEN 0 ELSE hits / given END * actual) / sum(actual), 8) FROM per"""
)
def weighted_precision(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy and weighted precision of a fixed rule for long months."""
    ruled = table(spark, folder, "orders").select(
        calendar.long_month_flag("o_orderdate").alias("label"),
        F.when(F.col("o_totalprice") > 150000, 1.0).otherwise(0.0).alias("prediction"),
    )
    return _rounded(sensor.month_report(ruled), ("value",))


@CATALOG.query("SELECT CAST(max(hour(ts)) + 1 AS BIGINT) AS classes FROM events")
def class_count(spark: SparkSession, folder: str) -> DataFrame:
    """Number of classes a model over the hours needs."""
    return classes.class_count(table(spark, folder, "events").select(F.hour("ts").alias("hour")), "hour")


@CATALOG.query(
    """SELECT round(100.0 * avg(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1.0 ELSE 0.0 END), 2) AS weekend_percent,
         count(*) AS n FROM events"""
)
def rounded_percent(spark: SparkSession, folder: str) -> DataFrame:
    """A share as a percentage with two digits."""
    share = F.avg(calendar.weekend_flag("ts").cast("double"))
    return table(spark, folder, "events").agg(
        numeric.percent(share).alias("weekend_percent"), F.count("*").alias("n")
    )


@CATALOG.query()
def hour_forest_cyclic(spark: SparkSession, folder: str) -> DataFrame:
    """Forest for the hour of day: accuracy and mean circular distance."""
    return sensor.hour_report(sensor.hour_case(_stored(spark, folder)).predictions)


@CATALOG.query()
def weekend_forest_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Forest for the weekend: accuracy per weekday."""
    scored = sensor.weekend_case(_stored(spark, folder), balance=True)
    return sensor.weekend_report(scored.predictions)


@CATALOG.query()
def device_forest_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Forest for the device type: accuracy per type."""
    return sensor.device_report(sensor.device_case(_stored(spark, folder)).predictions)


@CATALOG.query()
def top2_logit(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic regression for long months on line items, features chosen by spread.

    The hourly table covers one month only, so the line items and their ship months are used.
    """
    rows = lines(spark, folder).withColumn("label", calendar.long_month_flag("l_shipdate", exact=True))
    measured = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    features = profile.top_spread_columns(rows, measured, 2)
    clean = columns.drop_missing(rows.select("line_id", *features, "label"))
    parts = split.hash_split(clean, ["line_id"], {"train": 0.8, "test": 0.2}, 42)
    fitted = models.fit_logit(parts.filter(F.col("split") == "train"), features, "label")
    return sensor.month_report(fitted.apply(parts.filter(F.col("split") == "test")))


@CATALOG.query(
    """SELECT l_linenumber AS label,
         count(*) FILTER (p = 1) AS predicted_1, count(*) FILTER (p = 2) AS predicted_2,
         count(*) FILTER (p = 3) AS predicted_3, count(*) FILTER (p = 4) AS predicted_4,
         0::BIGINT AS predicted_other
       FROM (SELECT l_linenumber, CAST(l_quantity AS BIGINT) % 4 + 1 AS p FROM lineitem) GROUP BY 1"""
)
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Actual line numbers against a fixed rule."""
    ruled = table(spark, folder, "lineitem").select(
        "l_linenumber", (F.col("l_quantity").cast("long") % 4 + 1).alias("prediction")
    )
    return metrics.confusion_matrix(ruled, "l_linenumber", "prediction", (1, 2, 3, 4))


_GAPPED_SQL = """gapped AS (
  SELECT CAST(dayofweek(ts) IN (0, 6) AS INT) AS y,
    CASE WHEN value >= 5 THEN CAST(value > 20 AS INT) END AS p FROM events)"""


def _gapped(spark: SparkSession, folder: str) -> DataFrame:
    """Weekend label and a fixed rule that says nothing on small values."""
    rule = F.when(F.col("value") >= 5, F.when(F.col("value") > 20, 1.0).otherwise(0.0))
    return table(spark, folder, "events").select(calendar.weekend_flag("ts").alias("y"), rule.alias("p"))


@CATALOG.query(
    f"""WITH {_GAPPED_SQL} SELECT y AS label, count(*) FILTER (p = 0) AS predicted_0, count(*) FILTER (p = 1) AS predicted_1,
          count(*) FILTER (p IS NULL) AS predicted_other FROM gapped GROUP BY 1"""
)
def confusion_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion table of a rule that leaves rows without a prediction."""
    return metrics.confusion_matrix(_gapped(spark, folder), "y", "p", (0, 1))


@CATALOG.query(
    f"""WITH {_GAPPED_SQL}, c AS (SELECT count(*) AS n, count(*) FILTER (p = y) AS hits, sum(y) AS pos,
            count(*) FILTER (p = 1 AND y = 1) AS tp, count(*) FILTER (p = 0 AND y = 0) AS tn,
            count(*) FILTER (y = 0 AND coalesce(p, 1) = 1) AS fp FROM gapped)
        SELECT round(hits / n, 6) AS accuracy, round((tp / pos + tn / (n - pos)) / 2, 6) AS balanced_accuracy,
          round(tp / pos, 6) AS recall, round(tp / (tp + fp), 6) AS "precision", round(hits / n, 6) AS plain_accuracy FROM c"""
)
def scores_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """All scores of a rule that leaves rows without a prediction: they count as wrong."""
    ruled = _gapped(spark, folder)
    scores = metrics.binary_scores(metrics.binary_counts(ruled, "y", "p"))
    plain = metrics.accuracy(ruled, "y", "p").first()["accuracy"]
    rounded = [F.round(c, 6).alias(c) for c in metrics.BINARY_METRICS]
    return scores.select(*rounded, F.round(F.lit(plain), 6).alias("plain_accuracy"))


@CATALOG.query(
    """SELECT round(avg(CASE WHEN CAST(dayofweek(ts) IN (0, 6) AS INT) = CAST(value > 20 AS INT) THEN 1.0 ELSE 0.0 END), 8) AS accuracy
       FROM events WHERE value IS NOT NULL AND ts IS NOT NULL"""
)
def weekend_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Overall accuracy of a fixed weekend rule."""
    ruled = columns.drop_missing(table(spark, folder, "events").select("ts", "value")).select(
        calendar.weekend_flag("ts").alias("is_weekend"), F.when(F.col("value") > 20, 1.0).otherwise(0.0).alias("prediction")
    )
    return _rounded(metrics.accuracy(ruled, "is_weekend", "prediction"), ("accuracy",))


@CATALOG.query(
    f"""{_DEVICE_SQL}, idx AS (
          SELECT device_type, row_number() OVER (ORDER BY count(*) DESC, device_type) - 1 AS label
          FROM device GROUP BY 1)
        SELECT round(sum(CASE WHEN i.label = CAST(floor(d.power_value) AS BIGINT) % 5
            THEN 1 ELSE 0 END) / count(*), 8) AS accuracy
        FROM device d JOIN idx i ON d.device_type = i.device_type"""
)
def device_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Overall accuracy of a fixed rule for the device type."""
    devices = sensor.device_table(sensor_table(spark, folder))
    labelled = classes.attach(devices, "device_type", classes.category_index(devices, "device_type"))
    ruled = labelled.withColumn("prediction", F.floor("power_value") % 5)
    return _rounded(metrics.accuracy(ruled, "label", "prediction"), ("accuracy",))


@CATALOG.query()
def weekend_forest_plain(spark: SparkSession, folder: str) -> DataFrame:
    """Forest for the weekend without weights: accuracy per weekday."""
    return sensor.weekend_report(sensor.weekend_case(_stored(spark, folder)).predictions)


@CATALOG.query()
def month_logit(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic regression for the listed long months, on daily means of the line items."""
    return sensor.month_report(sensor.month_case(runtime.store(daily_sensor(spark, folder), "daily")).predictions)

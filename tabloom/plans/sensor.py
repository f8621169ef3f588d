"""Classification over a wide sensor table: hour, weekend, device type, length of month."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import calendar, numeric
from tabloom.operators import classes, columns, metrics, models, profile, reshape, split

# Measured and derived columns of the sensor plans, and the device types.
COOLING = ("power_water_cooling_01", "power_water_cooling_02")
ELEVATORS = ("power_elevator_01", "power_elevator_02")
CONSUMERS = (*COOLING, "power_ventilation", *ELEVATORS, "power_ev_charging")

HOUR_FEATURES = ("temperature", "humidity", "total_power_consumption", "power_solar_plant")
POWER_FEATURES = (
    "total_water_cooling",
    "power_ventilation",
    "total_elevator",
    "power_ev_charging",
    "power_solar_plant",
)
DEVICE_FEATURES = ("temperature", "humidity", "hour", "month", "power_value")
WEATHER = ("temperature", "humidity")
DEVICES = {
    "elevator": ELEVATORS,
    "ev_charging": ("power_ev_charging",),
    "solar_plant": ("power_solar_plant",),
    "ventilation": ("power_ventilation",),
    "water_cooling": COOLING,
}


def with_totals(df: DataFrame) -> DataFrame:
    """Add the sums over both cooling machines and over both elevators."""
    return columns.derive(
        df, {"total_water_cooling": numeric.row_sum(COOLING), "total_elevator": numeric.row_sum(ELEVATORS)}
    )


def hour_table(df: DataFrame) -> DataFrame:
    """Features and label ``hour``; incomplete rows removed."""
    derived = columns.derive(
        df,
        {
            "hour": calendar.hour_of_day("timestamp"),
            "total_power_consumption": numeric.row_sum(CONSUMERS),
        },
    )
    return columns.drop_missing(derived.select("timestamp", *HOUR_FEATURES, "hour"), [*HOUR_FEATURES, "hour"])


def weekend_table(df: DataFrame) -> DataFrame:
    """Power features, weekday columns and label ``is_weekend``; incomplete rows removed."""
    derived = columns.derive(
        with_totals(df),
        {
            "weekday": calendar.day_of_week("timestamp"),
            "weekday_name": calendar.day_name("timestamp"),
            "weekday_order": calendar.day_position("timestamp"),
            "is_weekend": calendar.weekend_flag("timestamp"),
        },
    )
    kept = ["weekday", "weekday_name", "weekday_order", "is_weekend"]
    return columns.drop_missing(derived.select("timestamp", *POWER_FEATURES, *kept), [*POWER_FEATURES, "weekday"])


def device_table(df: DataFrame) -> DataFrame:
    """One row per reading and device type; incomplete rows removed.

    ``timestamp`` stays as the key of the source row, for splits that keep its rows together.
    """
    derived = columns.derive(
        df, {"hour": calendar.hour_of_day("timestamp"), "month": calendar.month_of_year("timestamp")}
    )
    long = reshape.melt_groups(
        derived,
        {device: numeric.row_sum(measured) for device, measured in DEVICES.items()},
        ["timestamp", *WEATHER, "hour", "month"],
    )
    return columns.drop_missing(long, [*DEVICE_FEATURES, "device_type"])


def month_table(
    df: DataFrame, *, exact: bool = False, keep_undated: bool = False
) -> tuple[DataFrame, tuple[str, ...]]:
    """Weather, the two power columns that vary most, and label ``label`` (31-day month).

    Returns the table and its feature names, which depend on the data. The spread is
    measured before incomplete rows are removed. Rows without a timestamp are removed
    unless ``keep_undated``, which labels them 1.
    """
    totals = with_totals(df)
    features = (*WEATHER, *profile.top_spread_columns(totals, POWER_FEATURES, 2))
    labelled = totals.withColumn("label", calendar.long_month_flag("timestamp", exact=exact))
    needed = [*features, "label"] if keep_undated else ["timestamp", *features, "label"]
    return columns.drop_missing(labelled.select("timestamp", *features, "label"), needed), features


@dataclass(frozen=True)
class Scored:
    """A fitted model and its predictions for the held-out rows."""

    model: models.Fitted
    predictions: DataFrame


def _sides(df: DataFrame, key: Sequence[str], seed: int) -> tuple[DataFrame, DataFrame]:
    parts = split.hash_split(df, key, {"train": 0.8, "test": 0.2}, seed)
    return parts.filter(F.col("split") == "train"), parts.filter(F.col("split") == "test")


def _forest_case(
    df: DataFrame, key: Sequence[str], features: Sequence[str], label: str, seed: int, balance: bool
) -> Scored:
    train, test = _sides(df, key, seed)
    if balance:
        train = models.balanced(train, label)
    train = models.fixed_layout(train, key)
    fitted = models.fit_forest(train, features, label, trees=30, seed=seed, weight="weight" if balance else None)
    return Scored(fitted, fitted.apply(test))


def hour_case(df: DataFrame, *, seed: int = 123) -> Scored:
    return _forest_case(hour_table(df), ["timestamp"], HOUR_FEATURES, "hour", seed, False)


def weekend_case(df: DataFrame, *, seed: int = 123, balance: bool = False) -> Scored:
    return _forest_case(weekend_table(df), ["timestamp"], POWER_FEATURES, "is_weekend", seed, balance)


def device_case(df: DataFrame, *, seed: int = 123, by_reading: bool = True) -> Scored:
    """Device type from one power value; predictions carry the names again.

    All rows of one reading stay on one side of the split; ``by_reading=False`` splits row
    by row instead, so both sides can hold parts of the same reading.
    """
    table = device_table(df)
    index = classes.category_index(table, "device_type")
    labelled = classes.attach(table, "device_type", index)
    key = ["timestamp"] if by_reading else ["timestamp", "device_type"]
    scored = _forest_case(labelled, key, DEVICE_FEATURES, "label", seed, False)
    named = classes.index_names(scored.predictions, "prediction", index, "label", "device_type", "predicted_type")
    return Scored(scored.model, named)


def month_case(df: DataFrame, *, seed: int = 42, exact: bool = False) -> Scored:
    table, features = month_table(df, exact=exact)
    train, test = _sides(table, ["timestamp"], seed)
    fitted = models.fit_logit(train, features, "label")
    return Scored(fitted, fitted.apply(test))


def hour_report(predictions: DataFrame) -> DataFrame:
    """One row: accuracy and mean circular hour distance."""
    hit = F.when(F.col("hour") == F.col("prediction"), 1.0).otherwise(0.0)
    gap = numeric.cyclic_distance("prediction", "hour", 24)
    return predictions.agg(F.avg(hit).alias("accuracy"), F.avg(gap).alias("mean_error"))


def weekend_report(predictions: DataFrame, *, digits: int | None = 2) -> DataFrame:
    """Accuracy per weekday, Monday first."""
    table = metrics.accuracy_by(
        predictions, ["weekday_name", "weekday_order"], "is_weekend", "prediction", digits=digits
    )
    return columns.sorted_report(table, ["weekday_order"], [F.col("weekday_name").alias("weekday"), "accuracy"])


def device_report(predictions: DataFrame, *, digits: int | None = 2) -> DataFrame:
    """Accuracy per device type, best first."""
    table = metrics.accuracy_by(predictions, ["device_type"], "label", "prediction", digits=digits)
    return table.orderBy(F.desc("accuracy"), "device_type")


def month_report(predictions: DataFrame) -> DataFrame:
    """Rows (metric, value): accuracy and weighted precision."""
    rate = metrics.accuracy(predictions, "label", "prediction").unpivot([], ["accuracy"], "metric", "value")
    precision = metrics.weighted_precision(predictions, "label", "prediction")
    return rate.unionByName(precision.unpivot([], ["weighted_precision"], "metric", "value"))

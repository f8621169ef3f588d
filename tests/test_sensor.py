import datetime
import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import columns, reshape
from tabloom.plans import sensor
from tabloom.sources import schemas


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        ts = datetime.datetime(2025, 5, 1) + datetime.timedelta(hours=5 * i)
        sun = max(0.0, 12 - abs(ts.hour - 12)) * 10
        busy = 5.0 if ts.weekday() < 5 else 1.0
        row = [15 + sun / 10, 60.0 - sun / 5, busy * 10, 3.0, busy * 4, busy, rng.random(), rng.random() * 3, sun]
        if i % 50 == 0:
            row[rng.randrange(9)] = None
        rows.append((ts, *[v if v is None else v + rng.random() for v in row]))
    rows.append((None, *[1.0] * 9))
    return spark.createDataFrame(rows, schemas.SENSOR_SCHEMA).persist()


def test_hour_case(readings):
    report = sensor.hour_report(sensor.hour_case(readings).predictions).first()
    assert 0 < report["accuracy"] <= 1 and 0 <= report["mean_error"] < 6


def test_weekend_case(readings):
    report = sensor.weekend_report(sensor.weekend_case(readings, balance=True).predictions).collect()
    assert [r["weekday"] for r in report] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert min(r["accuracy"] for r in report) > 80


def test_device_case(readings):
    scored = sensor.device_case(readings)
    report = sensor.device_report(scored.predictions).collect()
    assert {r["device_type"] for r in report} == {"elevator", "ev_charging", "solar_plant", "ventilation", "water_cooling"}
    assert [r["accuracy"] for r in report] == sorted((r["accuracy"] for r in report), reverse=True)
    wrong = scored.predictions.filter((F.col("label") == F.col("prediction")) != (F.col("device_type") == F.col("predicted_type")))
    assert wrong.count() == 0
    rows = sensor.device_case(readings, by_reading=False).predictions
    assert rows.count() > 0


def test_device_table_scans_once(readings, spark, tmp_path):
    path = str(tmp_path / "sensor")
    readings.write.parquet(path)
    plan = sensor.device_table(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert sensor.device_table(readings).count() == sum(
        readings.filter(f"temperature + humidity + {power} + hour(timestamp) is not null").count()
        for power in (
            "power_elevator_01 + power_elevator_02",
            "power_ev_charging",
            "power_solar_plant",
            "power_ventilation",
            "power_water_cooling_01 + power_water_cooling_02",
        )
    )


def test_month_case(readings):
    table, features = sensor.month_table(readings)
    assert features == ("temperature", "humidity", "power_solar_plant", "total_water_cooling")
    undated, _ = sensor.month_table(readings, keep_undated=True)
    assert undated.count() == table.count() + 1
    assert undated.filter("timestamp is null").first()["label"] == 1
    report = {r["metric"]: r["value"] for r in sensor.month_report(sensor.month_case(readings).predictions).collect()}
    assert set(report) == {"accuracy", "weighted_precision"}


def test_weekend_table_drops_undated_rows(readings):
    assert sensor.weekend_table(readings).filter("timestamp is null").count() == 0


def test_drop_missing_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, k string")
    df.write.parquet(path)
    kept = columns.drop_missing(spark.read.parquet(path), ["x", "k"])
    assert [tuple(r) for r in kept.collect()] == [(1.0, "a")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(x), IsNotNull(k)" in plan


def test_stacking_keeps_repeats(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, n int")
    assert [tuple(r) for r in reshape.stack_tables([a, b]).collect()] == [(1, "x"), (1, "x")]
    assert reshape.distinct_rows(reshape.stack_tables([a, b]), ["n"]).count() == 1

"""Column names and types of the input tables."""

from pyspark.sql import types as T

# Columns of the minute-level sensor table.
SENSOR_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "temperature",
            "humidity",
            "power_water_cooling_01",
            "power_water_cooling_02",
            "power_ventilation",
            "power_elevator_01",
            "power_elevator_02",
            "power_ev_charging",
            "power_solar_plant",
        )
    ]
)

# Columns of the patient table.
PATIENT_SCHEMA = T.StructType(
    [
        T.StructField("Pregnancies", T.IntegerType()),
        T.StructField("Glucose", T.IntegerType()),
        T.StructField("BloodPressure", T.IntegerType()),
        T.StructField("SkinThickness", T.IntegerType()),
        T.StructField("Insulin", T.IntegerType()),
        T.StructField("BMI", T.DoubleType()),
        T.StructField("DiabetesPedigreeFunction", T.DoubleType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Outcome", T.IntegerType()),
    ]
)

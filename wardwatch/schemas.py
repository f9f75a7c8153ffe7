"""Schemas shared by batch tables, streams and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType()}


def columns(text: str) -> T.StructType:
    """Schema from `name TYPE, ...`; unlike the DDL reader it needs no running session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


VITALS = columns(
    "event_id BIGINT, patient_id STRING, age BIGINT, gender STRING, blood_pressure STRING,"
    " glucose_level DOUBLE, cholesterol BIGINT, bmi DOUBLE, diabetes STRING, hypertension STRING,"
    " medication_count BIGINT, length_of_stay BIGINT, discharge_destination STRING,"
    " event_ms BIGINT, arrival_ms BIGINT, source_partition BIGINT"
)

# The JSON a producer sends. The event time comes in `ts` or in timestamp.
VITALS_JSON = columns(
    "event_id BIGINT, patient_id STRING, age BIGINT, gender STRING, blood_pressure STRING,"
    " glucose_level DOUBLE, cholesterol BIGINT, bmi DOUBLE, diabetes STRING, hypertension STRING,"
    " medication_count BIGINT, length_of_stay BIGINT, discharge_destination STRING,"
    " ts BIGINT, timestamp BIGINT"
)

PATIENTS_CSV = columns(
    "patient_id INT, age INT, gender STRING, blood_pressure STRING, cholesterol INT, bmi DOUBLE,"
    " diabetes STRING, hypertension STRING, medication_count INT, length_of_stay INT,"
    " discharge_destination STRING, readmitted_30_days STRING"
)

METRICS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# The order of the model's inputs.
FEATURE_ORDER = (
    "age",
    "gender",
    "systolic_bp",
    "diastolic_bp",
    "cholesterol",
    "bmi",
    "diabetes",
    "hypertension",
    "medication_count",
    "length_of_stay",
    "discharge_destination",
)

REQUIRED_FIELDS = ("patient_id", "age", "blood_pressure", "bmi")

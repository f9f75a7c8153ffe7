"""The scorer as SQL functions, for queries written in SQL.

The functions are expressions, not Python: Spark puts their bodies into the plan of the query that
calls them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from wardwatch.functions import vitals as V
from wardwatch.functions.scores import BMI_LIMIT, DIASTOLIC_LIMIT, RISK_LIMIT, SYSTOLIC_LIMIT
from wardwatch.operators.features import FIELD_DEFAULTS
from wardwatch.operators.scoring import RISK_FACTOR_MODEL, RiskModel

VITALS_ARGUMENTS = "patient_id STRING, age BIGINT, glucose_level DOUBLE, blood_pressure STRING, bmi DOUBLE, ts BIGINT"


def _pressure(index: int, fallback: float) -> str:
    parts = "split(blood_pressure, '/')"
    return f"CASE WHEN size({parts}) = 2 THEN try_cast({parts}[{index}] AS DOUBLE) WHEN blood_pressure IS NOT NULL THEN {fallback}D END"


def _logit(model: RiskModel) -> str:
    inputs = {
        "age": "age",
        "systolic_bp": "systolic",
        "diastolic_bp": "diastolic",
        "bmi": "bmi",
        "cholesterol": str(FIELD_DEFAULTS["cholesterol"]),
        "length_of_stay": str(FIELD_DEFAULTS["length_of_stay"]),
        "hypertension": f"IF(systolic > {V.HYPERTENSION_SYSTOLIC} OR diastolic > {V.HYPERTENSION_DIASTOLIC}, 1, 0)",
        "bmi_over_30": "IF(bmi > 30, 1, 0)",
    }
    terms = [f"{model.weights[c]!r}D * {inputs[c]}" for c in model.feature_columns if model.weights.get(c) and c in inputs]
    return " + ".join([f"{float(model.intercept)!r}D", *terms])


def register_scoring_functions(spark: SparkSession, model: RiskModel = RISK_FACTOR_MODEL, name: str = "predict_patient_risk_json") -> None:
    """Register `name(patient_id, age, glucose_level, blood_pressure, bmi, ts)`, which gives the prediction as JSON.

    Fixed value: the default name, by which existing SQL calls the function.

    Features the arguments do not hold take the fixed values of the `vitals_only` policy. A row
    that cannot be scored gives `{patient_id, error, timestamp}`.
    """

    def define(function: str, arguments: str, returns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}({arguments}) RETURNS {returns} RETURN {body}")

    define("vitals_systolic", "blood_pressure STRING", "DOUBLE", _pressure(0, V.DEFAULT_SYSTOLIC))
    define("vitals_diastolic", "blood_pressure STRING", "DOUBLE", _pressure(1, V.DEFAULT_DIASTOLIC))
    readings = "age BIGINT, systolic DOUBLE, diastolic DOUBLE, bmi DOUBLE"
    define("vitals_risk", readings, "DOUBLE", f"1D / (1D + exp(-({_logit(model)})))")
    define(
        "vitals_anomaly",
        "risk DOUBLE, systolic DOUBLE, diastolic DOUBLE, bmi DOUBLE",
        "BOOLEAN",
        f"risk > {RISK_LIMIT}D OR systolic > {SYSTOLIC_LIMIT} OR diastolic > {DIASTOLIC_LIMIT} OR bmi > {BMI_LIMIT}",
    )
    systolic, diastolic = "vitals_systolic(blood_pressure)", "vitals_diastolic(blood_pressure)"
    risk = f"vitals_risk(age, {systolic}, {diastolic}, bmi)"
    now = "unix_millis(current_timestamp())"
    define(
        name,
        VITALS_ARGUMENTS,
        "STRING",
        f"""CASE WHEN age IS NULL OR bmi IS NULL OR ts IS NULL OR {systolic} IS NULL OR {diastolic} IS NULL
  THEN to_json(named_struct('patient_id', patient_id, 'error', 'a vital sign is missing or is no number', 'timestamp', ts))
  ELSE to_json(named_struct('patient_id', patient_id, 'risk_score', round({risk}, 4),
    'anomaly', vitals_anomaly({risk}, {systolic}, {diastolic}, bmi), 'age', age, 'glucose_level', glucose_level,
    'blood_pressure', blood_pressure, 'bmi', bmi, 'e2e_latency_ms', {now} - ts, 'timestamp', ts, 'processing_timestamp', {now})) END""",
    )

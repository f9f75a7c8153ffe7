"""The batch pipelines: score a table of events, replay history, train a model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.functions.records import project_prediction
from wardwatch.operators.history import HOUR_MS, latest_per_patient, feature_rows, vitals_delta
from wardwatch.operators.lateness import late_flag
from wardwatch.operators.scoring import RISK_FACTOR_MODEL, RiskModel, dead_letter, score_request, score_vitals, successful_only
from wardwatch.operators.training import (
    LABEL,
    as_risk_model,
    classification_report,
    predict_label,
    prepare_training,
    stratified_split,
    train_risk_model,
)
from wardwatch.schemas import FEATURE_ORDER
from wardwatch.sources.models import save_model


@dataclass(frozen=True)
class Outputs:
    predictions: DataFrame
    dead_letters: DataFrame
    features: DataFrame


def score_table(events: DataFrame, model: RiskModel = RISK_FACTOR_MODEL) -> Outputs:
    """Predictions, rejected rows and the latest features of a table of events."""
    scored = score_request(events, model)
    return Outputs(project_prediction(successful_only(scored)), dead_letter(scored), latest_per_patient(feature_rows(scored)))


def replay(events: DataFrame, model: RiskModel = RISK_FACTOR_MODEL, ttl_ms: int = HOUR_MS) -> DataFrame:
    """Score events and compare each with the patient's reading before."""
    return vitals_delta(score_request(events, model), ttl_ms)


def destination_summary(events: DataFrame, model: RiskModel = RISK_FACTOR_MODEL) -> DataFrame:
    """Risk, anomalies and lateness per discharge destination."""
    scored = score_vitals(events, model)
    return scored.groupBy("discharge_destination").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if("anomaly").alias("n_anomalies"),
        F.count_if(F.col("risk_score") > 0.7).alias("n_high_risk"),
        F.avg(F.when(F.col("error").isNull(), F.col("risk_score"))).alias("mean_risk"),
        F.count("error").alias("n_errors"),
        F.count_if(late_flag()).alias("n_late"),
        F.count_if(F.col(LABEL) == "Yes").alias("n_readmitted"),
    )


def train(spark: SparkSession, patients: DataFrame, key: str, path: str | None = None) -> tuple[RiskModel, DataFrame]:
    """Prepare, split, fit, judge on the held-out rows, and save where a path is given."""
    rows = prepare_training(patients, [key]).dropna(subset=[*FEATURE_ORDER, LABEL])
    parts = stratified_split(rows, key)
    fitted = train_risk_model(parts.where(~F.col("is_test")))
    model = as_risk_model(fitted)
    held_out = parts.where("is_test")
    if path:
        save_model(spark, fitted, path)
    return model, classification_report(predict_label(held_out, model, F.struct(*FEATURE_ORDER)))

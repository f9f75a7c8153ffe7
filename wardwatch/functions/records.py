"""Record shapes: projections of events and predictions, JSON text, lookup keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.functions.scores import round_score


def project_vitals(df: DataFrame) -> DataFrame:
    """The fields a scorer looks at, with the risk still at 0."""
    keep = [c for c in ("event_id", "event_ms") if c in df.columns]
    fields = ["patient_id", "age", "glucose_level", "blood_pressure", "bmi"]
    return df.select(*keep, *fields, F.lit(0.0).alias("readmission_risk"))


def project_prediction(df: DataFrame, full: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The prediction record: thirteen fields, or the five of the short form; `keep` adds key columns."""
    if not full:
        return df.select(
            *keep,
            "patient_id",
            "risk_score",
            "anomaly",
            F.col("arrival_ms").alias("processing_timestamp"),
            F.col("event_ms").alias("event_timestamp"),
        )
    timing = {c: F.col(c) if c in df.columns else F.lit(None).cast("double") for c in ("inference_ms", "feature_ms", "processing_ms")}
    return df.select(
        *keep,
        "patient_id",
        round_score(F.col("risk_score"), 4).alias("risk_score"),
        "anomaly",
        "age",
        "glucose_level",
        "blood_pressure",
        "bmi",
        *[round_score(col, 2).alias(name) for name, col in timing.items()],
        (F.col("arrival_ms") - F.col("event_ms")).alias("e2e_latency_ms"),
        F.col("event_ms").alias("timestamp"),
        F.col("arrival_ms").alias("processing_timestamp"),
    )


def as_json(df: DataFrame, alias: str = "value") -> DataFrame:
    """One JSON text per row, the form a topic takes."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(alias))


def feature_key(patient_id: Column) -> Column:
    return F.concat(F.lit("features:patient:"), patient_id)

"""Scoring with a logistic model whose coefficients are literals in the plan.

No Python runs per row, so column pruning and filters still reach the scan and the whole scorer is
one code-generated stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.functions.scores import anomaly_flag, sigmoid
from wardwatch.operators.features import featurize
from wardwatch.schemas import FEATURE_ORDER
from wardwatch.sources.vitals import event_time_error


@dataclass(frozen=True)
class RiskModel:
    """Weights in feature order, with the metadata a model is published under."""

    weights: Mapping[str, float]
    intercept: float
    version: str = "1.0"
    model_type: str = "LogisticRegression"
    feature_columns: tuple[str, ...] = field(default=FEATURE_ORDER)

    def logit(self, features: Column) -> Column:
        z = F.lit(float(self.intercept))
        for name in self.feature_columns:
            weight = float(self.weights.get(name, 0.0))
            if weight:
                z = z + _input(features, name) * F.lit(weight)
        return z


def _input(features: Column, name: str) -> Column:
    if name == "bmi_over_30":
        return (features["bmi"] > 30).cast("double")
    return F.coalesce(features[name], F.lit(0.0))


# Weights of the known risk factors; the intercept puts the 0.7 limit inside the range of scores.
RISK_FACTOR_MODEL = RiskModel(
    weights={
        "age": 0.01,
        "systolic_bp": 0.005,
        "diabetes": 0.3,
        "hypertension": 0.2,
        "medication_count": 0.05,
        "bmi_over_30": 0.15,
    },
    intercept=-1.5,
    feature_columns=(*FEATURE_ORDER, "bmi_over_30"),
)


def score_vitals(
    df: DataFrame, model: RiskModel = RISK_FACTOR_MODEL, policy: str = "service", bp_policy: str = "default", timed: bool = False
) -> DataFrame:
    """Add `features`, `risk_score`, `anomaly` and `error`. A row in error scores 0 and is no anomaly.

    With `timed`, an event time that is missing or far ahead of the arrival is an error too.
    """
    ready = featurize(df, policy, bp_policy)
    if timed:
        ready = event_time_error(ready)
    ok = F.col("error").isNull()
    f = F.col("features")
    scored = ready.withColumn("risk_score", F.when(ok, sigmoid(model.logit(f))).otherwise(F.lit(0.0)))
    flag = anomaly_flag(F.col("risk_score"), f["systolic_bp"], f["diastolic_bp"], F.col("bmi"))
    return scored.withColumn("anomaly", F.when(ok, flag).otherwise(F.lit(False)))


def score_request(df: DataFrame, model: RiskModel = RISK_FACTOR_MODEL) -> DataFrame:
    """The scoring service's contract: malformed pressure is an error, and each answer names the model version.

    An event without a time, or with one far ahead of its arrival, is an error too, so no path can skip that.
    """
    scored = score_vitals(df, model, "service", "reject", timed="event_ms" in df.columns)
    version = F.when(F.col("error").isNull(), F.lit(model.version))
    return scored.withColumn("model_version", version)


def model_table(spark: SparkSession, models: Sequence[RiskModel] = (RISK_FACTOR_MODEL,)) -> DataFrame:
    """Published models as a table, one row per version: weights by feature and intercept."""
    rows = [({k: float(v) for k, v in m.weights.items()}, float(m.intercept), m.version, m.model_type) for m in models]
    schema = "weights MAP<STRING,DOUBLE>, intercept DOUBLE, model_version STRING, model_type STRING"
    return spark.createDataFrame(rows, schema)


def score_with_model(df: DataFrame, models: DataFrame, policy: str = "service", bp_policy: str = "default") -> DataFrame:
    """Score each event with the published model its `model_version` names.

    The model table has one row per version. Spark broadcasts it while it is below the broadcast
    limit, so events are not shuffled. An event that names no published version is an error.
    """
    ready = featurize(df, policy, bp_policy)
    joined = ready.join(models.select("weights", "intercept", "model_version"), "model_version", "left")
    unknown = F.when(F.col("intercept").isNull(), F.concat(F.lit("Unknown model version: "), F.coalesce("model_version", F.lit("null"))))
    joined = joined.withColumn("error", F.coalesce(F.col("error"), unknown))
    z = F.col("intercept")
    for name in (*FEATURE_ORDER, "bmi_over_30"):
        z = z + _input(F.col("features"), name) * F.coalesce(F.try_element_at("weights", F.lit(name)), F.lit(0.0))
    ok = F.col("error").isNull()
    return joined.withColumn("risk_score", F.when(ok, sigmoid(z)).otherwise(F.lit(0.0))).drop("weights", "intercept")


def model_info(spark: SparkSession, model: RiskModel = RISK_FACTOR_MODEL) -> DataFrame:
    columns = F.array(*[F.lit(c) for c in model.feature_columns])
    return spark.range(1).select(
        F.lit(model.model_type).alias("model_type"),
        F.lit(model.version).alias("version"),
        columns.alias("feature_columns"),
        F.lit(len(model.feature_columns)).cast("bigint").alias("n_features"),
    )


def successful_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("error").isNull())


def dead_letter(df: DataFrame, inline: bool = False) -> DataFrame:
    """Rows in error: with their original record, or as a three-field record for the main output."""
    bad = df.where(F.col("error").isNotNull())
    if inline:
        return bad.select("patient_id", "error", F.col("event_ms").alias("timestamp"))
    added = {"error", "features", "risk_score", "anomaly", "model_version"}
    original = F.struct(*[F.col(c) for c in df.columns if c not in added])
    return bad.select(original.alias("original_data"), "error", F.col("event_ms").alias("timestamp"))

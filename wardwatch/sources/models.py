"""Saving and loading a trained model with its metadata."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import SparkSession

from wardwatch.operators.scoring import RiskModel
from wardwatch.operators.training import as_risk_model
from wardwatch.schemas import FEATURE_ORDER

METADATA = "feature_columns ARRAY<STRING>, model_type STRING, version STRING, n_features INT"


def save_model(spark: SparkSession, model: LogisticRegressionModel, path: str, features=FEATURE_ORDER, version: str = "1.0") -> None:
    model.write().overwrite().save(f"{path}/model")
    row = (list(features), "LogisticRegression", version, len(features))
    spark.createDataFrame([row], METADATA).write.mode("overwrite").json(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> RiskModel:
    """The saved model; without metadata the standard feature order is assumed."""
    fitted = LogisticRegressionModel.load(f"{path}/model")
    try:
        meta = spark.read.schema(METADATA).json(f"{path}/metadata").first()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        meta = None
    if meta is None:
        return as_risk_model(fitted)
    return as_risk_model(fitted, tuple(meta.feature_columns), meta.version)

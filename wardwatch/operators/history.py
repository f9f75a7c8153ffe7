"""Per-patient history: previous reading, newest prediction, last predictions, as-of lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwatch.functions.scores import abs_change
from wardwatch.operators.ordered import ROWS_PER_CHUNK, Scan, ordered_scan

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def vitals_delta(scored: DataFrame, ttl_ms: int = HOUR_MS, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Compare each reading with the patient's newest earlier reading that scored without error.

    A reading older than `ttl_ms` is forgotten, and then, as on the first reading, all changes are null.
    """
    f = F.col("features")
    reading = F.struct(
        F.col("event_ms").alias("ms"),
        F.col("glucose_level").alias("glucose"),
        f["systolic_bp"].alias("systolic"),
        f["diastolic_bp"].alias("diastolic"),
        F.col("risk_score").alias("risk"),
        F.col("anomaly").alias("anomaly"),
    )
    good = Scan("last", F.when(F.col("error").isNull(), reading), inclusive=False)
    scanned = ordered_scan(scored, ["patient_id"], ["event_ms", "event_id"], {"_prev": good}, rows_per_chunk)
    prev = F.col("_prev")
    valid = F.coalesce(F.col("event_ms") - prev["ms"] <= ttl_ms, F.lit(False))
    systolic_change = abs_change(f["systolic_bp"], prev["systolic"], valid)
    return scanned.withColumns(
        {
            "previous_ms": F.when(valid, prev["ms"]),
            "glucose_change": abs_change(F.col("glucose_level"), prev["glucose"], valid),
            "systolic_change": systolic_change,
            "diastolic_change": abs_change(f["diastolic_bp"], prev["diastolic"], valid),
            "bp_change": systolic_change,
            "previous_readmission_risk": F.when(valid, F.coalesce(prev["risk"], F.lit(0.0))),
            "previous_anomaly": F.when(valid, prev["anomaly"]),
        }
    ).drop("_prev")


def recent_history(predictions: DataFrame, keep: int = 100) -> DataFrame:
    """The newest `keep` predictions of each patient, newest first by `position`.

    Spark limits each group to `keep` rows before the shuffle as well, so a busy patient sends at
    most that many rows from each task.
    """
    newest = Window.partitionBy("patient_id").orderBy(F.col("event_ms").desc(), F.col("event_id").desc())
    return predictions.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= keep)


def latest_per_patient(predictions: DataFrame) -> DataFrame:
    """The newest record of each patient; partial maxima are taken before the shuffle."""
    rest = [c for c in predictions.columns if c != "patient_id"]
    newest = F.max_by(F.struct(*rest), F.struct("event_ms", "event_id"))
    return predictions.groupBy("patient_id").agg(newest.alias("_r")).select("patient_id", *[F.col(f"_r.{c}").alias(c) for c in rest])


def feature_rows(scored: DataFrame) -> DataFrame:
    """What the latest-features table holds about a successful prediction."""
    return scored.where(F.col("error").isNull()).select("patient_id", "risk_score", "anomaly", "event_ms", "event_id")


def upsert_features(stored: DataFrame, new: DataFrame, now_ms, ttl_ms: int = DAY_MS) -> DataFrame:
    """The table after new predictions came in: newest row per patient, expired rows gone.

    `now_ms` is a column or number: the moment expiry is judged at.
    """
    fresh = stored.unionByName(new).where(F.lit(now_ms) - F.col("event_ms") < ttl_ms)
    return latest_per_patient(fresh)


def enrich_latest(events: DataFrame, features: DataFrame, ttl_ms: int = DAY_MS, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Attach the newest features strictly before each event, by `(event_ms, event_id)`.

    Both sides go into one ordered stream per patient and the last features are carried forward:
    linear in the rows, where a range join would pair a patient's events with all its features.
    Without features younger than `ttl_ms` the risk is 0 and the anomaly flag false.
    """
    facts = F.struct("event_ms", "risk_score", "anomaly")
    left = events.withColumns({"_side": F.lit(0), "_facts": F.lit(None).cast(features.select(facts.alias("f")).schema["f"].dataType)})
    right = features.select("patient_id", "event_ms", "event_id", F.lit(1).alias("_side"), facts.alias("_facts"))
    both = left.unionByName(right, allowMissingColumns=True)
    seen = Scan("last", F.col("_facts"), inclusive=False)
    scanned = ordered_scan(both, ["patient_id"], ["event_ms", "event_id", "_side"], {"_seen": seen}, rows_per_chunk)
    seen = F.col("_seen")
    valid = F.coalesce(F.col("event_ms") - seen["event_ms"] < ttl_ms, F.lit(False))
    return (
        scanned.where(F.col("_side") == 0)
        .withColumns(
            {
                "previous_risk_score": F.when(valid, seen["risk_score"]).otherwise(F.lit(0.0)),
                "previous_anomaly": F.when(valid, seen["anomaly"]).otherwise(F.lit(False)),
            }
        )
        .drop("_side", "_facts", "_seen")
    )

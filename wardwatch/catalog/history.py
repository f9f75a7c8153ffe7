"""Per-patient history, reconciliation and sets of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardwatch.catalog.registry import query, r6
from wardwatch.fixtures import halves, vitals
from wardwatch.operators import history as H
from wardwatch.operators import reconcile as C
from wardwatch.operators.scoring import score_request, score_vitals, successful_only

# Chunks small enough that the given tables are split, so that path is checked too.
SMALL_CHUNK = 1_000

_DELTA_SQL = """
WITH seen AS (
  SELECT *, last_value(CASE WHEN error IS NULL THEN {{'ms': event_ms, 'g': glucose_level, 's': sys, 'd': dia, 'r': risk, 'a': anomaly}} END IGNORE NULLS)
    OVER (PARTITION BY patient_id ORDER BY event_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM judged),
kept AS (SELECT * REPLACE (CASE WHEN event_ms - p.ms <= {ttl} THEN p END AS p) FROM seen)
SELECT event_id, p.ms AS previous_ms, round(abs(glucose_level - p.g), 6) AS glucose_change, abs(sys0 - p.s) AS systolic_change,
  abs(dia0 - p.d) AS diastolic_change, round(p.r, 6) AS previous_readmission_risk, p.a AS previous_anomaly
FROM kept"""


def delta_columns(df):
    return df.select(
        "event_id",
        "previous_ms",
        r6("glucose_change", "glucose_change"),
        "systolic_change",
        "diastolic_change",
        r6("previous_readmission_risk", "previous_readmission_risk"),
        "previous_anomaly",
    )


def _delta(rows, ttl_ms, **options):
    return delta_columns(H.vitals_delta(score_request(rows), ttl_ms, **options))


@query("vitals_delta", "judged", _DELTA_SQL.format(ttl=H.HOUR_MS))
def _vitals_delta(spark, sf_dir):
    return _delta(vitals(spark, sf_dir), H.HOUR_MS)


@query("vitals_delta_day", "judged", _DELTA_SQL.format(ttl=H.DAY_MS))
def _vitals_delta_day(spark, sf_dir):
    return _delta(vitals(spark, sf_dir), H.DAY_MS)


@query(
    "vitals_delta_busy_patient",
    "vitals judged",
    _DELTA_SQL.format(ttl=H.DAY_MS).replace("FROM judged)", "FROM (SELECT * REPLACE (CASE WHEN gender = 'Male' THEN 'busy' ELSE patient_id END AS patient_id) FROM judged))"),
)
def _vitals_delta_busy_patient(spark, sf_dir):
    """A third of all rows belong to one patient, and the patient is split into chunks."""
    rows = vitals(spark, sf_dir).withColumn("patient_id", F.when(F.col("gender") == "Male", F.lit("busy")).otherwise(F.col("patient_id")))
    return _delta(rows, H.DAY_MS, rows_per_chunk=SMALL_CHUNK // 2)


@query(
    "recent_history",
    "judged",
    """
SELECT patient_id, event_id, round(risk, 6) AS risk_score, row_number() OVER newest AS position FROM judged WHERE error IS NULL
WINDOW newest AS (PARTITION BY patient_id ORDER BY event_ms DESC, event_id DESC) QUALIFY position <= 20""",
)
def _recent_history(spark, sf_dir):
    out = H.recent_history(successful_only(score_request(vitals(spark, sf_dir))), keep=20)
    return out.select("patient_id", "event_id", r6("risk_score", "risk_score"), F.col("position").cast("bigint").alias("position"))


@query(
    "latest_per_patient",
    "scored",
    """
SELECT patient_id, event_id, event_ms, round(risk, 6) AS risk_score, anomaly FROM scored
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY event_ms DESC, event_id DESC) = 1""",
)
def _latest_per_patient(spark, sf_dir):
    rows = score_vitals(vitals(spark, sf_dir)).select("patient_id", "event_id", "event_ms", "risk_score", "anomaly")
    return H.latest_per_patient(rows).withColumn("risk_score", F.round("risk_score", 6))


@query(
    "upsert_features",
    "judged",
    """
SELECT patient_id, round(risk, 6) AS risk_score, anomaly, event_ms, event_id FROM judged
WHERE error IS NULL AND (SELECT max(event_ms) FROM judged) - event_ms < 86400000
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY event_ms DESC, event_id DESC) = 1""",
)
def _upsert_features(spark, sf_dir):
    old, new = (H.feature_rows(score_request(part)) for part in halves(spark, sf_dir))
    now = vitals(spark, sf_dir).agg(F.max("event_ms")).first()[0]
    return H.upsert_features(H.latest_per_patient(old), new, now).withColumn("risk_score", F.round("risk_score", 6))


_AS_OF_SQL = """
WITH seen AS (
  SELECT *, last_value(CASE WHEN error IS NULL THEN {'ms': event_ms, 'r': risk, 'a': anomaly} END IGNORE NULLS)
    OVER (PARTITION BY patient_id ORDER BY event_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM judged),
kept AS (SELECT * REPLACE (CASE WHEN event_ms - p.ms < 86400000 THEN p END AS p) FROM seen)
SELECT event_id, patient_id, round(coalesce(p.r, 0), 6) AS previous_risk_score, coalesce(p.a, false) AS previous_anomaly FROM kept"""


def _enrich(spark, sf_dir, **options):
    rows = vitals(spark, sf_dir)
    out = H.enrich_latest(rows, H.feature_rows(score_request(rows)), **options)
    return out.select("event_id", "patient_id", r6("previous_risk_score", "previous_risk_score"), "previous_anomaly")


@query("enrich_latest", "judged", _AS_OF_SQL)
def _enrich_latest(spark, sf_dir):
    return _enrich(spark, sf_dir)


@query("enrich_latest_split", "judged", _AS_OF_SQL)
def _enrich_latest_split(spark, sf_dir):
    return _enrich(spark, sf_dir, rows_per_chunk=50)


@query(
    "reconcile",
    "judged",
    """
SELECT count(*) AS sent, count(*) FILTER (error IS NULL) AS processed, count(*) FILTER (error IS NOT NULL) AS missing, 0::bigint AS duplicates,
  round(count(*) FILTER (error IS NULL) / count(*), 6) AS success_rate, count(*) FILTER (error IS NOT NULL) = 0 AS all_processed
FROM judged""",
)
def _reconcile(spark, sf_dir):
    sent = vitals(spark, sf_dir)
    out = C.reconcile(sent, successful_only(score_request(sent)))
    return out.withColumn("success_rate", F.round("success_rate", 6))


@query(
    "reconcile_by_checksum",
    "judged",
    """
SELECT count(*) AS sent_rows, count(*) FILTER (error IS NULL) AS received_rows, count(*) FILTER (error IS NOT NULL) AS missing,
  0::bigint AS unexpected, 0::bigint AS duplicates, count(*) FILTER (error IS NOT NULL) = 0 AS all_processed
FROM judged""",
)
def _reconcile_by_checksum(spark, sf_dir):
    sent = vitals(spark, sf_dir)
    return C.reconcile_by_checksum(sent, successful_only(score_request(sent)))


@query(
    "differing_keys",
    "judged",
    "SELECT event_id, 1::bigint AS sent, (CASE WHEN event_id % 97 = 0 THEN 2 ELSE 0 END)::bigint AS received FROM judged WHERE event_id % 97 = 0 OR event_id % 101 = 0",
)
def _differing_keys(spark, sf_dir):
    """Some events came out twice, some never."""
    sent = vitals(spark, sf_dir).select("event_id")
    twice = sent.where("event_id % 97 = 0")
    return C.differing_keys(sent, C.combine_batches(sent.where("event_id % 101 <> 0 OR event_id % 97 = 0"), twice))


@query("missing_keys", "judged", "SELECT event_id FROM judged WHERE error IS NOT NULL")
def _missing_keys(spark, sf_dir):
    sent = vitals(spark, sf_dir)
    return C.missing_keys(sent, successful_only(score_request(sent)))


@query("distinct_processed", "judged", "SELECT count(DISTINCT patient_id) AS processed_patients, count(*) AS records FROM judged WHERE error IS NULL")
def _distinct_processed(spark, sf_dir):
    return C.distinct_processed(successful_only(score_request(vitals(spark, sf_dir))))


@query(
    "combine_batches",
    "before_ after_",
    "SELECT patient_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (FROM before_ UNION ALL FROM after_) GROUP BY ALL",
)
def _combine_batches(spark, sf_dir):
    both = C.combine_batches(*halves(spark, sf_dir))
    return both.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(
    "dedupe_events",
    "vitals",
    "SELECT event_id, patient_id, event_ms FROM vitals",
)
def _dedupe_events(spark, sf_dir):
    """Events sent twice, as after a retry, count once."""
    rows = vitals(spark, sf_dir).select("event_id", "patient_id", "event_ms")
    return C.dedupe_events(C.combine_batches(rows, rows))

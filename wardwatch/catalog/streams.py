"""Streams over the given tables. Each runs until its input is used up and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.catalog.history import _AS_OF_SQL, _DELTA_SQL, delta_columns
from wardwatch.catalog.alerts import CHANGES_SQL
from wardwatch.catalog.quality import _DAILY_DRIFT, _TIERS_SQL, _WATCH_SQL
from wardwatch.catalog.registry import query
from wardwatch.fixtures import as_vitals, events, reference, vitals
from wardwatch.operators.drift import reference_means
from wardwatch.operators.history import DAY_MS, HOUR_MS
from wardwatch.operators.scoring import score_request
from wardwatch.session import work_dir
from wardwatch.sinks.tables import latest_revision
from wardwatch.streaming import queries as S
from wardwatch.streaming.alerting import alert_changes_stream
from wardwatch.streaming.state import patient_state_stream, use_rocksdb
from wardwatch.streaming.watch import drift_watch_stream
from wardwatch.streaming.windows import tumbling_vitals

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


SLICES = 4
_SLICED: dict[tuple[str, str, str], tuple[str, int]] = {}


def _sliced(spark, sf_dir, order):
    """The events as files that follow each other in `order`, and how many files make one batch."""
    key = (spark.sparkContext.applicationId, sf_dir, order)
    if key not in _SLICED:
        path = work_dir(spark, "event-slices")
        rows = vitals(spark, sf_dir).select("event_id", order)
        cuts = rows.approxQuantile(order, [i / SLICES for i in range(1, SLICES)], 0.001)
        bounds = [None, *cuts, None]
        raw = events(spark, sf_dir).join(rows, "event_id")
        for low, high in zip(bounds, bounds[1:]):
            part = raw if low is None else raw.where(F.col(order) > low)
            part = part if high is None else part.where(F.col(order) <= high)
            part.select(*EVENTS.names).write.mode("append").parquet(path)
        files = len(spark.read.parquet(path).inputFiles())
        _SLICED[key] = (path, max(1, files // SLICES))
    return _SLICED[key]


def _vitals_stream(spark, sf_dir, order="event_ms"):
    """The table in batches that follow each other in `order`."""
    path, files = _sliced(spark, sf_dir, order)
    return as_vitals(spark, spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path))


@query(
    "scoring_stream",
    "judged",
    """
SELECT event_id, patient_id, round(risk, 4) AS risk_score, anomaly, NULL::varchar AS error FROM judged WHERE error IS NULL
UNION ALL SELECT event_id, patient_id, NULL, NULL, 'could not convert string to float: ''n''' FROM judged WHERE error IS NOT NULL""",
)
def _scoring_stream(spark, sf_dir):
    base = work_dir(spark, "scoring")
    paths = S.ScoringPaths(f"{base}/predictions", f"{base}/dead-letters")
    S.run_available(_vitals_stream(spark, sf_dir), S.scoring_writer(paths), f"{base}/checkpoint")
    good = spark.read.parquet(paths.predictions).select("event_id", "patient_id", "risk_score", "anomaly")
    bad = spark.read.parquet(paths.dead_letters).select("original_data.event_id", "original_data.patient_id", "error")
    return good.unionByName(bad, allowMissingColumns=True).select("event_id", "patient_id", "risk_score", "anomaly", "error")


@query(
    "features_stream",
    "judged",
    """
SELECT patient_id, event_id, event_ms, round(risk, 6) AS risk_score, anomaly FROM judged
WHERE error IS NULL AND (SELECT max(event_ms) FROM judged WHERE error IS NULL) - event_ms < 86400000
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY event_ms DESC, event_id DESC) = 1""",
)
def _features_stream(spark, sf_dir):
    base = work_dir(spark, "features")
    paths = S.ScoringPaths(f"{base}/predictions", f"{base}/dead-letters", f"{base}/features", f"{base}/history")
    S.run_available(_vitals_stream(spark, sf_dir), S.scoring_writer(paths), f"{base}/checkpoint")
    return S.live_features(spark, paths.features).withColumn("risk_score", F.round("risk_score", 6))


@query(
    "history_stream",
    "judged",
    """
SELECT patient_id, event_id, event_ms, round(risk, 6) AS risk_score, anomaly FROM judged WHERE error IS NULL
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY event_ms DESC, event_id DESC) <= 20""",
)
def _history_stream(spark, sf_dir):
    base = work_dir(spark, "history")
    paths = S.ScoringPaths(f"{base}/predictions", f"{base}/dead-letters", history=f"{base}/history")
    S.run_available(_vitals_stream(spark, sf_dir), S.scoring_writer(paths, keep=20), f"{base}/checkpoint")
    return S.history_table(paths.history, 20).read(spark).withColumn("risk_score", F.round("risk_score", 6))


@query("patient_state_stream", "judged", _DELTA_SQL.format(ttl=DAY_MS))
def _patient_state_stream(spark, sf_dir):
    """The batches follow the clock of arrival, so late rows come after newer ones."""
    use_rocksdb(spark)
    base = work_dir(spark, "patient-state")
    changes = patient_state_stream(score_request(_vitals_stream(spark, sf_dir, "arrival_ms")), DAY_MS)
    S.run_available(changes, S.table_writer(f"{base}/changes"), f"{base}/checkpoint", empty_batches=False)
    return delta_columns(latest_revision(spark.read.parquet(f"{base}/changes"), ["patient_id", "event_id"]))


@query("patient_changes_stream", "judged", _DELTA_SQL.format(ttl=DAY_MS))
def _patient_changes_stream(spark, sf_dir):
    base = work_dir(spark, "patient-changes")
    write = S.delta_writer(f"{base}/changes", f"{base}/state", ttl_ms=DAY_MS)
    S.run_available(_vitals_stream(spark, sf_dir), write, f"{base}/checkpoint")
    return delta_columns(spark.read.parquet(f"{base}/changes"))


@query(
    "tumbling_vitals_stream",
    "vitals",
    """
SELECT event_ms // 3600000 * 3600000 AS window_ms, discharge_destination, count(*) AS n, round(avg(glucose_level), 6) AS mean_glucose,
  max(bmi) AS max_bmi, max(arrival_ms - event_ms) AS max_delay_ms FROM vitals GROUP BY ALL""",
)
def _tumbling_vitals_stream(spark, sf_dir):
    base = work_dir(spark, "tumbling")
    windows = tumbling_vitals(_vitals_stream(spark, sf_dir), "1 hour")
    S.run_available(windows, S.table_writer(f"{base}/windows"), f"{base}/checkpoint", "update")
    out = latest_revision(spark.read.parquet(f"{base}/windows"), ["window_ms", "discharge_destination"])
    return out.withColumn("mean_glucose", F.round("mean_glucose", 6))


@query("lateness_stream", "vitals", _TIERS_SQL)
def _lateness_stream(spark, sf_dir):
    base = work_dir(spark, "lateness")
    write = S.lateness_writer(f"{base}/main", f"{base}/side", f"{base}/seen")
    S.run_available(_vitals_stream(spark, sf_dir, "arrival_ms"), write, f"{base}/checkpoint")
    both = spark.read.parquet(f"{base}/main").unionByName(spark.read.parquet(f"{base}/side"))
    return both.select("event_id", "behind_ms", "tier")


@query("drift_stream", "vitals reference", _DAILY_DRIFT.replace(" AS t_ms", " AS window_ms").replace("SELECT t_ms", "SELECT window_ms"))
def _drift_stream(spark, sf_dir):
    base = work_dir(spark, "drift")
    columns = ["age", "bmi", "glucose_level"]
    windows = S.drift_stream(_vitals_stream(spark, sf_dir), columns, "1 day")
    S.run_available(windows, S.drift_writer(f"{base}/drift", reference(spark, sf_dir), columns), f"{base}/checkpoint", "update")
    out = latest_revision(spark.read.parquet(f"{base}/drift"), ["window_ms"])
    return out.withColumn("drift_score", F.round("drift_score", 6))


@query("dedupe_stream", "vitals", "SELECT event_id, patient_id, event_ms FROM vitals")
def _dedupe_stream(spark, sf_dir):
    """Every event is sent twice."""
    base = work_dir(spark, "dedupe")
    twice = _vitals_stream(spark, sf_dir).unionByName(_vitals_stream(spark, sf_dir))
    once = S.dedupe_stream(twice).select("event_id", "patient_id", "event_ms")
    S.run_available(once, S.table_writer(f"{base}/events"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/events").drop("batch_id")


@query(
    "drift_watch_stream",
    "vitals reference",
    # The last rows wait for the timer of the wall clock, unless they fill a check.
    _WATCH_SQL.format(timer=5 * DAY_MS) + " WHERE hi < (SELECT max(r) FROM n) OR n_rows = 1000",
)
def _drift_watch_stream(spark, sf_dir):
    use_rocksdb(spark)
    base = work_dir(spark, "drift-watch")
    columns = ["age", "bmi", "glucose_level"]
    known = reference_means(reference(spark, sf_dir), columns)
    checks = drift_watch_stream(_vitals_stream(spark, sf_dir, "arrival_ms"), known, columns, timer_ms=5 * DAY_MS)
    S.run_available(checks, S.table_writer(f"{base}/checks"), f"{base}/checkpoint", empty_batches=False)
    out = spark.read.parquet(f"{base}/checks").drop("batch_id")
    return out.withColumns({c: F.round(c, 6) for c in ("drift_score", "late_data_ratio")})


@query("alert_stream", "", CHANGES_SQL)
def _alert_stream(spark, sf_dir):
    """Changes of an alert on every event's value, per type, as far as the last watermark."""
    use_rocksdb(spark)
    base = work_dir(spark, "alerts")
    path, files = _sliced(spark, sf_dir, "event_ms")
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)
    series = rows.select(F.col("event_type").alias("source"), F.unix_millis(F.col("ts").cast("timestamp")).alias("t_ms"), "value")
    changes = alert_changes_stream(series, ["source"], F.col("value") < 60, 2 * HOUR_MS, HOUR_MS, "0 seconds")
    S.run_available(changes, S.table_writer(f"{base}/changes"), f"{base}/checkpoint", empty_batches=True)
    return spark.read.parquet(f"{base}/changes").drop("batch_id")


@query("enrich_stream", "judged", _AS_OF_SQL)
def _enrich_stream(spark, sf_dir):
    base = work_dir(spark, "enrich")
    write = S.enrich_writer(f"{base}/enriched", f"{base}/history")
    S.run_available(_vitals_stream(spark, sf_dir), write, f"{base}/checkpoint")
    out = spark.read.parquet(f"{base}/enriched")
    return out.select("event_id", "patient_id", F.round("previous_risk_score", 6).alias("previous_risk_score"), "previous_anomaly")

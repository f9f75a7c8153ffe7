"""Streaming queries: each batch is written under its id, so a restart neither loses nor repeats rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wardwatch.functions.records import as_json, project_prediction
from wardwatch.operators.drift import min_rows, reference_means, score_window_means
from wardwatch.operators.history import DAY_MS, HOUR_MS, enrich_latest, feature_rows, latest_per_patient, recent_history, vitals_delta
from wardwatch.operators.lateness import lateness_tiers, newest_by_source
from wardwatch.operators.scoring import RISK_FACTOR_MODEL, RiskModel, dead_letter, score_request, successful_only
from wardwatch.sinks.keyed import KeyedTable
from wardwatch.sinks.snapshots import read_version, update_version
from wardwatch.sinks.tables import write_batch
from wardwatch.streaming.windows import ALLOWED_DELAY, CODED_DELAY, window_means, with_watermark

FEATURES = "patient_id STRING, risk_score DOUBLE, anomaly BOOLEAN, event_ms BIGINT, event_id BIGINT"
HISTORY = FEATURES
SEEN = "source_partition BIGINT, seen_ms BIGINT"

# Fixed value: how often a batch starts, and with it a checkpoint is written.
TRIGGER = "1 second"

Batch = Callable[[DataFrame, int], None]


def checkpointed(df: DataFrame, write: Batch, checkpoint: str, mode: str = "append", trigger: str | None = TRIGGER, name: str | None = None) -> StreamingQuery:
    """Start a query that hands each batch to `write`; without a trigger it takes what is there and ends."""
    writer: DataStreamWriter = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for a while; a query that starts meanwhile keeps it."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def run_available(df: DataFrame, write: Batch, checkpoint: str, mode: str = "append", timeout: int = 600, empty_batches: bool | None = None) -> None:
    """Process what is there and return; a failure or a timeout is raised.

    A query whose state has timers or expiry on the wall clock would run batches without rows for ever, and is
    given `empty_batches=False`; one with event-time timers needs them to fire behind the last row.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    value = df.sparkSession.conf.get(name) if empty_batches is None else str(empty_batches).lower()
    with setting(df.sparkSession, name, value):
        query = checkpointed(df, write, checkpoint, mode, trigger=None)
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout} seconds")


def table_writer(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> Batch:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(shape(batch), path, batch_id)

    return write


def json_writer(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> Batch:
    """Each record of a batch as one JSON text, the form a topic takes; a replay of the batch replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        as_json(shape(batch)).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


@dataclass(frozen=True)
class ScoringPaths:
    """Where the scoring query writes; each is a folder of its own."""

    predictions: str
    dead_letters: str
    features: str | None = None
    history: str | None = None


def features_table(path: str) -> KeyedTable:
    return KeyedTable(path, FEATURES, "patient_id", latest_per_patient)


def history_table(path: str, keep: int = 100) -> KeyedTable:
    return KeyedTable(path, HISTORY, "patient_id", lambda rows: recent_history(rows, keep).drop("position"))


def scoring_writer(paths: ScoringPaths, model: RiskModel = RISK_FACTOR_MODEL, ttl_ms: int = DAY_MS, keep: int = 100) -> Batch:
    """Score a batch; good rows go to predictions and history, bad rows to the dead letters.

    A batch adds its rows to the keyed tables as a run of its own. Expired rows go when their run is merged, and
    `live_features` leaves out those that are still there, judged by the newest event seen. Events far
    ahead of their arrival are dead letters, so no clock but the receiver's own moves the expiry.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score_request(batch, model).persist()
        try:
            write_batch(project_prediction(successful_only(scored), keep=("event_id",)), paths.predictions, batch_id)
            write_batch(dead_letter(scored), paths.dead_letters, batch_id)
            spark = batch.sparkSession
            fresh = feature_rows(scored)
            if paths.features:
                newest = fresh.agg(F.max("event_ms")).first()[0] or 0
                features_table(paths.features).update(spark, batch_id, fresh, F.lit(newest) - F.col("event_ms") < ttl_ms)
            if paths.history:
                history_table(paths.history, keep).update(spark, batch_id, fresh)
        finally:
            scored.unpersist()

    return write


def live_features(spark: SparkSession, path: str, ttl_ms: int = DAY_MS) -> DataFrame:
    """The newest features of each patient, without those that have expired by the newest event seen."""
    table = features_table(path).read(spark)
    newest = table.agg(F.max("event_ms")).first()[0] or 0
    return table.where(F.lit(newest) - F.col("event_ms") < ttl_ms)


def enrich_writer(enriched: str, history: str, model: RiskModel = RISK_FACTOR_MODEL, ttl_ms: int = DAY_MS, keep: int = 100) -> Batch:
    """Score a batch, and attach to each event the newest features of its patient before it: the lookup inside the stream.

    What a patient had before the batch comes from the keyed history as of the batch before, so a replay sees what the
    first run saw; only the segments that the batch's patients fall into are opened. A row that comes late finds its
    features among the last `keep` predictions of its patient.
    """
    table = history_table(history, keep)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        scored = score_request(batch, model).persist()
        try:
            fresh = feature_rows(scored)
            before = table.read(spark, batch_id, scored)
            write_batch(enrich_latest(scored, before.unionByName(fresh), ttl_ms), enriched, batch_id)
            table.update(spark, batch_id, fresh)
        finally:
            scored.unpersist()

    return write


def lateness_writer(main: str, side: str, seen: str) -> Batch:
    """Split a batch by how late its rows are; the newest event per source is kept between batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            prior = read_version(spark, seen, SEEN, before=batch_id)
            tiers = lateness_tiers(rows, prior)
            write_batch(tiers.where(F.col("tier") != "side_output"), main, batch_id)
            write_batch(tiers.where(F.col("tier") == "side_output"), side, batch_id)

            def merge(old: DataFrame) -> DataFrame:
                return old.unionByName(newest_by_source(rows)).groupBy("source_partition").agg(F.max("seen_ms").alias("seen_ms"))

            update_version(spark, seen, SEEN, batch_id, merge)
        finally:
            rows.unpersist()

    return write


READINGS = (
    "patient_id STRING, event_id BIGINT, event_ms BIGINT, glucose_level DOUBLE,"
    " features STRUCT<systolic_bp: DOUBLE, diastolic_bp: DOUBLE>, risk_score DOUBLE, anomaly BOOLEAN, error STRING"
)


def readings(scored: DataFrame) -> DataFrame:
    """Of scored events, what the next reading of a patient is compared with."""
    pressure = F.struct("features.systolic_bp", "features.diastolic_bp").alias("features")
    return scored.select("patient_id", "event_id", "event_ms", "glucose_level", pressure, "risk_score", "anomaly", "error")


def readings_table(path: str) -> KeyedTable:
    return KeyedTable(path, READINGS, "patient_id", latest_per_patient)


def delta_writer(changes: str, state: str, model: RiskModel = RISK_FACTOR_MODEL, ttl_ms: int = HOUR_MS) -> Batch:
    """Changes since the patient's reading before, for streams in which one patient may send very much.

    The last good reading of each patient is a table kept between batches. It joins the batch as
    rows of its own, so the ordered scan of the batch operator finds it and splits a busy patient.
    Rows that were sent again with the same `event_id` in a batch are taken once.
    """

    table = readings_table(state)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = readings(score_request(batch, model)).dropDuplicates(["patient_id", "event_ms", "event_id"]).persist()
        try:
            before = table.read(spark, batch_id, rows)
            both = rows.withColumn("_stored", F.lit(False)).unionByName(before.withColumn("_stored", F.lit(True)))
            write_batch(vitals_delta(both, ttl_ms).where(~F.col("_stored")).drop("_stored", "features"), changes, batch_id)
            # One row per patient; whether it has expired is judged by the patient's own next reading.
            table.update(spark, batch_id, successful_only(rows))
        finally:
            rows.unpersist()

    return write


def drift_stream(df: DataFrame, columns: Sequence[str], width: str = "60 seconds", delay: str = ALLOWED_DELAY) -> DataFrame:
    """Row counts and means per window; `drift_writer` scores them against the reference."""
    return window_means(df, columns, width, delay)


def drift_writer(path: str, reference: DataFrame, columns: Sequence[str]) -> Batch:
    """Score each revised window. The reference is summarised once, when the query starts."""
    known = reference_means(reference, columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(score_window_means(min_rows(batch), ["window_ms"], known, columns), path, batch_id)

    return write


def dedupe_stream(df: DataFrame, keys: Sequence[str] = ("event_id",), delay: str = CODED_DELAY) -> DataFrame:
    """Drop events that were sent again within `delay` of event time."""
    return with_watermark(df, delay).dropDuplicatesWithinWatermark(list(keys))

"""Alert states over metric series, and the rules that are watched."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.operators.ordered import ROWS_PER_CHUNK, Scan, ordered_scan, plan_splits, settle
from wardwatch.session import stage


# Fixed value: a series without a sample for longer than this says nothing.
STALE_MS = 300_000


def alert_hold(
    series: DataFrame,
    keys: Sequence[str],
    condition: Column,
    hold_ms: int,
    time: str = "t_ms",
    rows_per_chunk: int = ROWS_PER_CHUNK,
    max_gap_ms: int = STALE_MS,
) -> DataFrame:
    """Add `state` and `active_since_ms`: a condition that has held for `hold_ms` fires.

    A series has one sample per time. A run of true samples starts where the sample before was
    not true, or lies more than `max_gap_ms` back; until it has lasted long enough it is pending.
    The series is read several times; it should be a stored table.
    """
    splits = plan_splits(series, keys, [time], rows_per_chunk)
    flagged = series.withColumn("_on", F.coalesce(condition, F.lit(False)))
    previous = {"_was": Scan("last", F.col("_on"), inclusive=False), "_at": Scan("last", F.col(time), inclusive=False)}
    flagged = settle(flagged, splits, "alert-samples")
    marked = settle(ordered_scan(flagged, keys, [time], previous, None, splits), splits, "alert-flags")
    goes_on = F.coalesce(F.col("_was") & (F.col(time) - F.col("_at") <= max_gap_ms), F.lit(False))
    start = F.when(F.col("_on") & ~goes_on, F.col(time))
    started = ordered_scan(marked.withColumn("_start", start), keys, [time], {"_since": Scan("last", F.col("_start"))}, None, splits)
    on = F.col("_on")
    held = F.col(time) - F.col("_since") >= hold_ms
    state = F.when(~on, F.lit("inactive")).when(held, F.lit("firing")).otherwise(F.lit("pending"))
    return started.withColumns({"active_since_ms": F.when(on, F.col("_since")), "state": state}).drop("_on", "_was", "_at", "_start", "_since")


def alert_changes(
    series: DataFrame,
    keys: Sequence[str],
    condition: Column,
    hold_ms: int,
    until_ms: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    max_gap_ms: int = STALE_MS,
) -> DataFrame:
    """When the alert of each series changed: `(keys, at_ms, state, since_ms, value)`.

    A condition holds from a true sample to the next sample, or for `max_gap_ms` where none comes. It is pending from
    its first true sample, fires once it has held for `hold_ms`, and ends as `resolved` if it had fired, else as `inactive`.
    Changes later than `until_ms` (by default the newest sample of all) are not known yet. The value is that of the last
    true sample before the change, or of the sample that ended it.
    """
    states = stage(alert_hold(series.select(*keys, "t_ms", "value"), keys, condition, hold_ms, rows_per_chunk=rows_per_chunk, max_gap_ms=max_gap_ms), "alert-states")
    if until_ms is None:
        until_ms = states.agg(F.max("t_ms")).first()[0] or 0
    before = F.struct("t_ms", "active_since_ms", "value")
    scanned = ordered_scan(states, keys, ["t_ms"], {"_was": Scan("last", before, inclusive=False)}, rows_per_chunk)
    was, since = F.col("_was"), F.col("active_since_ms")
    ended = was["active_since_ms"].isNotNull() & (since.isNull() | (since != was["active_since_ms"]))
    near = F.col("t_ms") - was["t_ms"] <= max_gap_ms
    ends = scanned.where(ended).select(
        *keys,
        was["active_since_ms"].alias("since_ms"),
        was["t_ms"].alias("last_ms"),
        F.when(near, F.col("t_ms")).otherwise(was["t_ms"] + max_gap_ms).alias("end_ms"),
        F.when(near, F.col("value")).otherwise(was["value"]).alias("end_value"),
        near.alias("cut"),
    )
    newest = F.max_by(F.struct("t_ms", "active_since_ms", "value"), F.col("t_ms"))
    last = states.groupBy(*keys).agg(newest.alias("_l")) if keys else states.agg(newest.alias("_l"))
    stale = F.col("_l.t_ms") + max_gap_ms
    still = last.where(F.col("_l.active_since_ms").isNotNull()).select(
        *keys,
        F.col("_l.active_since_ms").alias("since_ms"),
        F.col("_l.t_ms").alias("last_ms"),
        stale.alias("end_ms"),
        F.col("_l.value").alias("end_value"),
        F.lit(False).alias("cut"),
    )
    runs = ends.unionByName(still)
    fires = F.col("since_ms") + hold_ms
    # A sample at the end of the hold is taken before the alert fires; a condition that only goes stale then has held.
    fired = F.when(F.col("cut"), fires < F.col("end_ms")).otherwise(fires <= F.col("end_ms")) | F.lit(hold_ms == 0)
    value_at = states.select(*keys, F.col("t_ms"), F.col("value"), F.col("active_since_ms").alias("since_ms")).where(F.col("since_ms").isNotNull())
    at_start = F.min_by("value", F.col("t_ms")).alias("first_value")
    at_fire = F.max_by(F.when(F.col("t_ms") <= fires, F.col("value")), F.when(F.col("t_ms") <= fires, F.col("t_ms"))).alias("fire_value")
    values = value_at.groupBy(*keys, "since_ms").agg(at_start, at_fire)
    joint = [F.col(f"r.{k}").eqNullSafe(F.col(f"v.{k}")) for k in keys] + [F.col("r.since_ms") == F.col("v.since_ms")]
    full = runs.alias("r").join(values.alias("v"), joint).select("r.*", "v.first_value", "v.fire_value")

    def change(at: Column, state: Column | str, value: str, there: Column) -> Column:
        return F.when(there, F.struct(at.alias("at_ms"), (F.lit(state) if isinstance(state, str) else state).alias("state"), F.col(value).alias("value")))

    changes = F.array_compact(
        F.array(
            change(F.col("since_ms"), "pending", "first_value", F.lit(hold_ms > 0)),
            change(fires, "firing", "fire_value", fired),
            change(F.col("end_ms"), F.when(fired, "resolved").otherwise("inactive"), "end_value", F.lit(True)),
        )
    )
    listed = full.select(*keys, "since_ms", F.explode(changes).alias("c"))
    return listed.where(F.col("c.at_ms") <= until_ms).select(*keys, "c.at_ms", "c.state", "since_ms", "c.value")


@dataclass(frozen=True)
class AlertRule:
    """A limit on a value, how long it must be broken, and the text to send."""

    name: str
    limit: float
    hold_ms: int
    severity: str
    text: str
    equal: bool = False
    percent: bool = False

    def condition(self, value: Column) -> Column:
        return value == self.limit if self.equal else value > self.limit


# Limits, hold times and severities of the alerts.
HIGH_PROCESSING_LATENCY = AlertRule("HighProcessingLatency", 10_000, 60_000, "warning", "Processing latency is %.2f ms")
MODEL_SERVER_DOWN = AlertRule("ModelServerDown", 0, 30_000, "critical", "The scoring service sends no heartbeat (up = %.0f)", equal=True)
HIGH_PREDICTION_LATENCY = AlertRule("HighPredictionLatency", 0.05, 120_000, "warning", "p99 prediction latency is %.4f seconds")
HIGH_PREDICTION_ERRORS = AlertRule("HighPredictionErrors", 0.1, 120_000, "warning", "Prediction error rate is %.4f per second")
HIGH_LAG = AlertRule("HighKafkaLag", 1000, 300_000, "critical", "The consumer group lags by %.0f messages")
PARTITION_LAG = AlertRule("KafkaConsumerLag", 1000, 300_000, "critical", "A partition lags by %.0f messages")
DATA_DRIFT_DETECTED = AlertRule("DataDriftDetected", 0, 300_000, "warning", "Data drift detected: %.0f")
HIGH_LATE_RATIO = AlertRule("HighLateDataRatio", 0.1, 300_000, "warning", "Share of late data: %.2f%%", percent=True)


def alert_text(rule: AlertRule, value: Column) -> Column:
    shown = value * 100 if rule.percent else value
    return F.format_string(rule.text, shown.cast("double"))


def evaluate_rule(
    series: DataFrame, rule: AlertRule, keys: Sequence[str] = (), max_gap_ms: int = STALE_MS, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """State of a rule at every sample of `(keys, t_ms, value)`; the text is set where it is not inactive."""
    samples = stage(series.select(*keys, "t_ms", "value"), "alert-series")
    states = alert_hold(samples, keys, rule.condition(F.col("value")), rule.hold_ms, rows_per_chunk=rows_per_chunk, max_gap_ms=max_gap_ms)
    text = F.when(F.col("state") != "inactive", alert_text(rule, F.col("value")))
    return states.select(
        F.lit(rule.name).alias("alert"), F.lit(rule.severity).alias("severity"), *keys, "t_ms", "value", "active_since_ms", "state", text.alias("description")
    )

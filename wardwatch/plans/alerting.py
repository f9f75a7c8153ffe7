"""The metric series behind each alert and panel, and the queries over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwatch.functions.scores import DRIFT_BANDS, LATE_BANDS, LATENCY_BANDS, RISK_BANDS, severity_band
from wardwatch.functions.timing import bytes_to_mb, cell_end, cell_start, ms_to_seconds
from wardwatch.operators import alerts as A
from wardwatch.operators import requests as R
from wardwatch.operators.drift import WINDOW_MIN_ROWS, score_window_means, shift_by_window
from wardwatch.operators.ordered import Scan, ordered_scan
from wardwatch.operators.lateness import event_time_lag, late_flag, late_ratio, late_ratio_by_window
from wardwatch.operators.reconcile import metric_or
from wardwatch.session import stage

MINUTE_MS = 60_000
PANEL_POINTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def lag_series(df: DataFrame, width_ms: int = MINUTE_MS) -> DataFrame:
    return event_time_lag(df, width_ms).select(F.col("window_ms").alias("t_ms"), F.col("lag_ms").cast("double").alias("value"))


def service_intervals(df: DataFrame, by: Sequence[str], step_ms: int = MINUTE_MS, until_ms: int | None = None, clock: DataFrame | None = None) -> DataFrame:
    """When each service was up and when down: `(by, from_ms, to_ms, up)`, first and last step of each interval.

    A service is watched from its first heartbeat to `until_ms`, or else to the newest `arrival_ms` of `clock`, the
    receiver's own log, so a lone service that stops is down too; without either, to the newest heartbeat of any.
    Later heartbeats do not count. The number of rows follows the interruptions, however long these are.
    """
    seen = df.select(*by, "arrival_ms").where(F.col("arrival_ms") <= until_ms) if until_ms is not None else df
    beats = stage(seen.select(*by, cell_start(F.col("arrival_ms"), step_ms).alias("t_ms")).distinct(), "heartbeats")
    if until_ms is None:
        until_ms = (clock.agg(F.max("arrival_ms")) if clock is not None else beats.agg(F.max("t_ms"))).first()[0]
    end = F.lit((until_ms or 0) // step_ms * step_ms)
    beats = beats.where(F.col("t_ms") <= end)
    before = stage(ordered_scan(beats, by, ["t_ms"], {"_before": Scan("last", F.col("t_ms"), inclusive=False)}), "heartbeat-gaps")
    start = F.col("_before").isNull() | (F.col("t_ms") - F.col("_before") > step_ms)
    runs = ordered_scan(before, by, ["t_ms"], {"_since": Scan("last", F.when(start, F.col("t_ms")))})
    up = runs.groupBy(*by, F.col("_since").alias("from_ms")).agg(F.max("t_ms").alias("to_ms")).withColumn("up", F.lit(True))
    hole = [(F.col("_before") + step_ms).alias("from_ms"), (F.col("t_ms") - step_ms).alias("to_ms"), F.lit(False).alias("up")]
    holes = before.where(start & F.col("_before").isNotNull()).select(*by, *hole)
    last = before.groupBy(*by).agg(F.max("t_ms").alias("_last")) if by else before.agg(F.max("t_ms").alias("_last"))
    tail = last.where(F.col("_last") < end).select(*by, (F.col("_last") + step_ms).alias("from_ms"), end.alias("to_ms"), F.lit(False).alias("up"))
    return up.unionByName(holes).unionByName(tail)


def heartbeat_series(intervals: DataFrame, by: Sequence[str], step_ms: int = MINUTE_MS) -> DataFrame:
    """`up` of each service at every step of its intervals, for panels: 1 with a heartbeat in the step, else 0."""
    steps = F.explode(F.sequence("from_ms", "to_ms", F.lit(step_ms))).alias("t_ms")
    return intervals.select(*by, "from_ms", steps, F.when(F.col("up"), 1.0).otherwise(0.0).alias("value"))


def down_alerts(intervals: DataFrame, by: Sequence[str], rule: A.AlertRule = A.MODEL_SERVER_DOWN, step_ms: int = MINUTE_MS) -> DataFrame:
    """One row for each time that a service was down long enough: since when, when it fired, and when it came back, if it did."""
    over = F.col("to_ms") + step_ms
    fires = F.col("from_ms") + rule.hold_ms
    newest = intervals.groupBy(*by).agg(F.max("to_ms").alias("_end")) if by else intervals.agg(F.max("to_ms").alias("_end"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    down = intervals.where(~F.col("up") & (fires < over)).join(newest.withColumnsRenamed({c: f"_key_{c}" for c in by}), on)
    back = F.when(F.col("to_ms") < F.col("_end"), over)
    return down.select(F.lit(rule.name).alias("alert"), *by, F.col("from_ms").alias("since_ms"), fires.alias("firing_ms"), back.alias("resolved_ms"))


def source_lag(df: DataFrame, by: Sequence[str] = ("source_partition",), step_ms: int = MINUTE_MS) -> DataFrame:
    """Rows produced but not yet consumed, per partition and step.

    Each row is +1 at its event and -1 at its arrival. The steps are summed before the running
    total, which so runs over at most one row per partition and step.
    """
    produced = df.select(*by, cell_end(F.col("event_ms"), step_ms).alias("t_ms"), F.lit(1).alias("_d"))
    consumed = df.select(*by, cell_end(F.col("arrival_ms"), step_ms).alias("t_ms"), F.lit(-1).alias("_d"))
    steps = produced.unionByName(consumed).groupBy(*by, "t_ms").agg(F.sum("_d").alias("_d"))
    running = F.sum("_d").over(Window.partitionBy(*by).orderBy("t_ms").rowsBetween(Window.unboundedPreceding, 0))
    return steps.select(*by, "t_ms", running.cast("double").alias("value"))


def latency_quantiles(requests: DataFrame, by: Sequence[str] = (), step_ms: int = MINUTE_MS, range_ms: int = R.RATE_RANGE_MS) -> DataFrame:
    return R.histogram_quantiles(R.bucket_rates(requests, by, step_ms, range_ms), [*by, "t_ms"], PANEL_POINTS)


def gap_of(step_ms: int) -> int:
    """Samples one step apart belong together, however long the step."""
    return max(A.STALE_MS, step_ms)


def high_processing_latency(df: DataFrame, width_ms: int = MINUTE_MS) -> DataFrame:
    return A.evaluate_rule(lag_series(df, width_ms), A.HIGH_PROCESSING_LATENCY, max_gap_ms=gap_of(width_ms))


def model_server_down(df: DataFrame, by: Sequence[str], step_ms: int = MINUTE_MS, until_ms: int | None = None, clock: DataFrame | None = None) -> DataFrame:
    """The state of the rule at every step; `down_alerts` says the same in one row for each time."""
    rule = A.MODEL_SERVER_DOWN
    steps = heartbeat_series(service_intervals(df, by, step_ms, until_ms, clock), by, step_ms)
    down = F.col("value") == 0
    since = F.when(down, F.col("from_ms"))
    held = F.col("t_ms") - F.col("from_ms") >= rule.hold_ms
    state = F.when(~down, F.lit("inactive")).when(held, F.lit("firing")).otherwise(F.lit("pending"))
    text = F.when(down, A.alert_text(rule, F.col("value")))
    named = [F.lit(rule.name).alias("alert"), F.lit(rule.severity).alias("severity")]
    return steps.select(*named, *by, "t_ms", "value", since.alias("active_since_ms"), state.alias("state"), text.alias("description"))


def high_prediction_latency(requests: DataFrame, by: Sequence[str] = (), step_ms: int = MINUTE_MS, range_ms: int = R.RATE_RANGE_MS) -> DataFrame:
    p99 = R.histogram_quantile(R.bucket_rates(requests, by, step_ms, range_ms), [*by, "t_ms"], 0.99, "value")
    return A.evaluate_rule(p99.withColumn("value", ms_to_seconds(F.col("value"))), A.HIGH_PREDICTION_LATENCY, by, gap_of(step_ms))


def high_prediction_errors(counter: DataFrame, by: Sequence[str]) -> DataFrame:
    rates = R.counter_rate(counter, by).select(*by, F.col("ms").alias("t_ms"), F.col("rate").alias("value"))
    return A.evaluate_rule(rates, A.HIGH_PREDICTION_ERRORS, by)


def high_lag(partition_lag: DataFrame, rule: A.AlertRule = A.HIGH_LAG) -> DataFrame:
    return A.evaluate_rule(R.sum_series(partition_lag, ["t_ms"]), rule)


def partition_lag_alert(partition_lag: DataFrame, by: Sequence[str] = ("source_partition",), rule: A.AlertRule = A.PARTITION_LAG) -> DataFrame:
    return A.evaluate_rule(partition_lag, rule, by)


def drift_series(df: DataFrame, reference: DataFrame, columns: Sequence[str], width_ms: int = MINUTE_MS) -> DataFrame:
    """Drift score and flag per event-time window with enough rows."""
    cells = df.withColumn("t_ms", cell_start(F.col("event_ms"), width_ms))
    return shift_by_window(cells, ["t_ms"], reference, columns)


def data_drift_detected(df: DataFrame, reference: DataFrame, columns: Sequence[str], width_ms: int = MINUTE_MS) -> DataFrame:
    flags = drift_series(df, reference, columns, width_ms).select("t_ms", F.col("drift_detected").cast("double").alias("value"))
    return A.evaluate_rule(flags, A.DATA_DRIFT_DETECTED, max_gap_ms=gap_of(width_ms))


def high_late_ratio(df: DataFrame, width_ms: int = MINUTE_MS) -> DataFrame:
    ratio = late_ratio_by_window(df, width_ms).select(F.col("window_ms").alias("t_ms"), F.col("late_data_ratio").alias("value"))
    return A.evaluate_rule(ratio, A.HIGH_LATE_RATIO, max_gap_ms=gap_of(width_ms))


def latency_panel(requests: DataFrame, step_ms: int = MINUTE_MS, range_ms: int = R.RATE_RANGE_MS) -> DataFrame:
    quantiles = latency_quantiles(requests, (), step_ms, range_ms)
    return quantiles.withColumn("band", severity_band(F.col("p99"), LATENCY_BANDS))


def throughput_panel(requests: DataFrame, step_ms: int = MINUTE_MS, range_ms: int = R.RATE_RANGE_MS) -> DataFrame:
    """Requests and errors per second at every step that a request reaches, down to 0 after the last."""
    steps = requests.groupBy(cell_end(F.col("ms"), step_ms).alias("t_ms")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("status") != "success").alias("_bad")
    )
    sums = R.trailing_sums(steps, (), ["_n", "_bad"], step_ms, range_ms)
    seconds = range_ms / 1000.0
    return sums.select("t_ms", (F.col("_n") / seconds).alias("predictions_per_sec"), (F.col("_bad") / seconds).alias("errors_per_sec"))


def lag_panel(group_lag: DataFrame, partition_lag: DataFrame, delays: DataFrame, watched: str) -> DataFrame:
    """Series of the lag panel: total lag, the watched group's lag, event-time lag in ms and seconds.

    The total takes the group sums and, at times without any, the sum over partitions.
    """
    total = metric_or(R.sum_series(group_lag, ["t_ms"]), R.sum_series(partition_lag, ["t_ms"]), ["t_ms"])
    own = group_lag.where(F.col("consumer_group") == watched).groupBy("t_ms").agg(F.sum("value").alias("value"))
    seconds = delays.withColumn("value", ms_to_seconds(F.col("value")))
    parts = [("total_lag", total), ("group_lag", own), ("event_time_lag_ms", delays), ("event_time_lag_s", seconds)]
    out = None
    for name, part in parts:
        rows = part.select(F.lit(name).alias("series"), "t_ms", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def quality_panel(df: DataFrame, reference: DataFrame, columns: Sequence[str], width_ms: int = MINUTE_MS) -> DataFrame:
    """Drift and late share per window, each with its band; a window too small for drift shows lateness only.

    One aggregation gives the means and the late counts of all windows.
    """
    cell = cell_start(F.col("event_ms"), width_ms).alias("t_ms")
    late = F.count_if(late_flag()).alias("late_data_count")
    windows = df.groupBy(cell).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.lit(1)).alias("total_data_count"), late, *[F.avg(c).alias(c) for c in columns]
    )
    scored = score_window_means(late_ratio(windows), ["t_ms", "late_data_count", "late_data_ratio"], reference, columns)
    large = F.col("n_rows") >= WINDOW_MIN_ROWS
    score = F.when(large, F.col("drift_score"))
    return scored.select(
        "t_ms",
        score.alias("drift_score"),
        F.when(large, F.col("drift_detected").cast("bigint")).alias("drift_detected"),
        F.when(large, severity_band(F.col("drift_score"), DRIFT_BANDS)).alias("drift_band"),
        "late_data_ratio",
        (F.col("late_data_count") / (width_ms / 1000.0)).alias("late_per_sec"),
        severity_band(F.col("late_data_ratio"), LATE_BANDS).alias("late_band"),
    )


def risk_gauge(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The newest risk score with its band."""
    newest = R.last_gauge(scored.where(F.col("error").isNull()), by, "risk_score", ["event_ms", "event_id"])
    return newest.withColumn("band", severity_band(F.col("risk_score"), RISK_BANDS))


def state_panel(metrics: DataFrame, step_ms: int = MINUTE_MS) -> DataFrame:
    """Of each streaming query and step: the longest checkpoint in seconds, and the newest state size in megabytes.

    Reads the metric table that `ProgressMetrics` writes; the sizes of a query's state operators add up.
    """
    query, operator = F.col("labels")["query"].alias("query"), F.coalesce(F.col("labels")["operator"], F.lit("")).alias("operator")
    cells = metrics.select("metric", query, operator, cell_start(F.col("ts_ms"), step_ms).alias("t_ms"), "ts_ms", "value")
    took = cells.where("metric = 'checkpoint_duration_ms'").groupBy("query", "t_ms").agg(ms_to_seconds(F.max("value")).alias("checkpoint_seconds"))
    held = cells.where("metric = 'state_size_bytes'").groupBy("query", "operator", "t_ms").agg(F.max_by("value", F.struct("ts_ms", "value")).alias("value"))
    size = held.groupBy("query", "t_ms").agg(bytes_to_mb(F.sum("value")).alias("state_mb"))
    return took.join(size, ["query", "t_ms"], "full")

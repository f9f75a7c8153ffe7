"""Alert states and dashboard panels over metric series of the given tables.

The given events are minutes apart, so the series use hours and days where a live system uses
minutes; limits and hold times are those of the rules unless a query says otherwise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardwatch.catalog.history import SMALL_CHUNK
from wardwatch.catalog.registry import query, r6
from wardwatch.catalog.quality import _shift_of
from wardwatch.fixtures import HALF_DAY, counter, reference, requests, vitals
from wardwatch.operators import alerts as A
from wardwatch.operators.lateness import late_ratio_by_window
from wardwatch.operators.scoring import score_vitals
from wardwatch.plans import alerting as P
from wardwatch.session import stage

HOUR_MS, DAY_MS = 3_600_000, 86_400_000
DRIFT_COLUMNS = ["age", "bmi", "glucose_level"]


def hold_sql(series: str, condition: str, hold_ms: int, keys: str = "", digits: int = 6, gap_ms: int = HOUR_MS) -> str:
    """Check SQL: islands of true samples of `series(keys, t_ms, value)`, none across a hole, and their state."""
    by = f"PARTITION BY {keys}" if keys else ""
    also = f"PARTITION BY {keys}, island" if keys else "PARTITION BY island"
    listed = f"{keys}, " if keys else ""
    return f"""
flagged AS (SELECT *, coalesce({condition}, false) AS yes FROM {series}),
cut AS (SELECT *, NOT yes OR coalesce(t_ms - lag(t_ms) OVER ({by} ORDER BY t_ms) > {gap_ms}, false) AS breaks FROM flagged),
islands AS (SELECT *, sum(breaks::int) OVER ({by} ORDER BY t_ms) AS island FROM cut),
begun AS (SELECT *, min(CASE WHEN yes THEN t_ms END) OVER ({also}) AS since FROM islands)
SELECT {listed}t_ms, round(value, {digits}) AS value, CASE WHEN yes THEN since END AS active_since_ms,
  CASE WHEN NOT yes THEN 'inactive' WHEN t_ms - since >= {hold_ms} THEN 'firing' ELSE 'pending' END AS state
FROM begun"""


def _states(df, *keys, digits=6):
    return df.select(*keys, "t_ms", F.round("value", digits).alias("value"), "active_since_ms", "state")


_LATE_BY_HOUR = """
WITH s AS (SELECT event_ms // 3600000 * 3600000 AS t_ms, avg((arrival_ms - event_ms > 300000)::int) AS value FROM vitals GROUP BY ALL),"""


# Check SQL: the changes of an alert on `value < 60` that must hold for two hours, where a sample speaks for one hour.
CHANGES_SQL = """
WITH s AS (SELECT event_type AS source, epoch_us(ts) // 1000 AS t_ms, max(value) AS value FROM events GROUP BY ALL),
w AS (SELECT max(t_ms) AS until FROM s),
f AS (SELECT *, value < 60 AS yes, lag(t_ms) OVER o AS t0, lag(value < 60) OVER o AS y0, lead(t_ms) OVER o AS t1, lead(value) OVER o AS v1
  FROM s WINDOW o AS (PARTITION BY source ORDER BY t_ms)),
g AS (SELECT *, sum((NOT (coalesce(y0, false) AND t_ms - t0 <= 3600000))::int) OVER (PARTITION BY source ORDER BY t_ms) AS island FROM f WHERE yes),
r AS (SELECT source, min(t_ms) AS since_ms, max(t_ms) AS last_ms, arg_min(value, t_ms) AS v0, arg_max(value, t_ms) AS v_last, last(t1 ORDER BY t_ms) AS next_ms,
  last(v1 ORDER BY t_ms) AS next_v, list(value ORDER BY t_ms) AS vs, list(t_ms ORDER BY t_ms) AS ts FROM g GROUP BY source, island),
e AS (SELECT *, next_ms IS NOT NULL AND next_ms - last_ms <= 3600000 AS cut, since_ms + 7200000 AS fire_ms FROM r),
d AS (SELECT *, CASE WHEN cut THEN next_ms ELSE last_ms + 3600000 END AS end_ms, CASE WHEN cut THEN next_v ELSE v_last END AS end_v FROM e),
h AS (SELECT *, CASE WHEN cut THEN fire_ms < end_ms ELSE fire_ms <= end_ms END AS fired FROM d)
SELECT source, since_ms AS at_ms, 'pending' AS state, since_ms, v0 AS value FROM h, w WHERE since_ms <= until
UNION ALL SELECT source, fire_ms, 'firing', since_ms, vs[len(list_filter(ts, lambda x: x <= fire_ms))] FROM h, w WHERE fired AND fire_ms <= until
UNION ALL SELECT source, end_ms, CASE WHEN fired THEN 'resolved' ELSE 'inactive' END, since_ms, end_v FROM h, w WHERE end_ms <= until"""


@query("alert_changes", "", CHANGES_SQL)
def _alert_changes(spark, sf_dir):
    samples = requests(spark, sf_dir).groupBy("source", F.col("ms").alias("t_ms")).agg(F.max("latency_ms").alias("value"))
    return A.alert_changes(stage(samples, "samples"), ["source"], F.col("value") < 60, 2 * HOUR_MS, max_gap_ms=HOUR_MS)


@query("alert_hold", "vitals", _LATE_BY_HOUR + hold_sql("s", "value > 0.02", 7_200_000))
def _alert_hold(spark, sf_dir):
    ratio = late_ratio_by_window(vitals(spark, sf_dir), HOUR_MS).select(F.col("window_ms").alias("t_ms"), F.col("late_data_ratio").alias("value"))
    return _states(A.alert_hold(stage(ratio, "ratio"), [], F.col("value") > 0.02, 7_200_000, max_gap_ms=HOUR_MS))


@query(
    "alert_hold_raw_samples",
    "counter",
    "WITH s AS (SELECT source, ms AS t_ms, value FROM counter)," + hold_sql("s", "value > 500", 3_600_000, "source"),
)
def _alert_hold_raw_samples(spark, sf_dir):
    """Series of raw samples are split into chunks."""
    series = counter(spark, sf_dir).select("source", F.col("ms").alias("t_ms"), "value")
    return _states(A.alert_hold(series, ["source"], F.col("value") > 500, HOUR_MS, rows_per_chunk=SMALL_CHUNK, max_gap_ms=HOUR_MS), "source")


@query(
    "high_processing_latency",
    "vitals",
    "WITH s AS (SELECT arrival_ms // 3600000 * 3600000 AS t_ms, max(arrival_ms - event_ms)::double AS value FROM vitals GROUP BY ALL),"
    + hold_sql("s", "value > 10000", 60_000),
)
def _high_processing_latency(spark, sf_dir):
    return _states(P.high_processing_latency(vitals(spark, sf_dir), HOUR_MS))


@query(
    "alert_text",
    "vitals",
    """
WITH s AS (SELECT event_ms // 3600000 * 3600000 AS t_ms, avg((arrival_ms - event_ms > 300000)::int) AS value FROM vitals GROUP BY ALL)
SELECT t_ms, 'HighLateDataRatio' AS alert, 'warning' AS severity,
  CASE WHEN value > 0.1 THEN concat('Share of late data: ', printf('%.2f', value * 100), '%') END AS description FROM s""",
)
def _alert_text(spark, sf_dir):
    return P.high_late_ratio(vitals(spark, sf_dir), HOUR_MS).select("t_ms", "alert", "severity", "description")


@query(
    "model_server_down",
    "vitals",
    """
WITH beats AS (SELECT DISTINCT source_partition, arrival_ms // 3600000 * 3600000 AS t_ms FROM vitals
  WHERE NOT (source_partition = 2 AND ts >= TIMESTAMP '2024-01-16')),
life AS (SELECT source_partition, min(t_ms) AS born FROM beats GROUP BY ALL),
grid AS (SELECT source_partition, t_ms FROM (SELECT unnest(range(min(t_ms), max(t_ms) + 1, 3600000)) AS t_ms FROM beats) JOIN life ON t_ms >= born),
s AS (SELECT source_partition, g.t_ms, CASE WHEN b.t_ms IS NULL THEN 0e0 ELSE 1e0 END AS value FROM grid g LEFT JOIN beats b USING (source_partition, t_ms)),"""
    + hold_sql("s", "value = 0", 30_000, "source_partition"),
)
def _model_server_down(spark, sf_dir):
    """One source stops for good in the middle of the month and stays down."""
    gone = (F.col("source_partition") == 2) & (F.col("ts") >= F.lit(HALF_DAY).cast("timestamp_ntz"))
    return _states(P.model_server_down(vitals(spark, sf_dir).where(~gone), ["source_partition"], HOUR_MS), "source_partition")


@query(
    "down_alerts",
    "vitals",
    """
WITH beats AS (SELECT DISTINCT source_partition, arrival_ms // 3600000 * 3600000 AS t_ms FROM vitals WHERE source_partition = 2 AND ts < TIMESTAMP '2024-01-16'),
e AS (SELECT max(arrival_ms) // 3600000 * 3600000 AS stop FROM vitals),
n AS (SELECT *, lead(t_ms) OVER (PARTITION BY source_partition ORDER BY t_ms) AS next_ms FROM beats)
SELECT 'ModelServerDown' AS alert, source_partition, t_ms + 3600000 AS since_ms, t_ms + 3630000 AS firing_ms, next_ms AS resolved_ms
FROM n, e WHERE coalesce(next_ms - t_ms > 3600000, t_ms < stop)""",
)
def _down_alerts(spark, sf_dir):
    """A lone source that stops for good, watched by the arrival clock of all events."""
    rows = vitals(spark, sf_dir)
    lone = rows.where((F.col("source_partition") == 2) & (F.col("ts") < F.lit(HALF_DAY).cast("timestamp_ntz")))
    return P.down_alerts(P.service_intervals(lone, ["source_partition"], HOUR_MS, clock=rows), ["source_partition"], step_ms=HOUR_MS)


_RATES_SQL = """
WITH les AS (SELECT unnest([1, 2, 5, 10, 20, 30, 50, 100, 200, 500, 1000, NULL]) AS b),
cells AS (SELECT *, ceil(ms / 3600000)::bigint * 3600000 AS cell FROM requests),
times AS (SELECT DISTINCT cell + k * 3600000 AS t_ms FROM cells, range(0, 6) r(k)),
hist AS (SELECT t_ms, b, count(*) FILTER (b IS NULL OR latency_ms <= b) / 21600 AS cum, count(*) / 21600 AS n
  FROM times JOIN cells ON cell <= t_ms AND cell > t_ms - 21600000, les GROUP BY ALL),
steps AS (SELECT *, coalesce(lag(b) OVER w, 0) AS lo, coalesce(lag(cum) OVER w, 0) AS below FROM hist WINDOW w AS (PARTITION BY t_ms ORDER BY b NULLS LAST)),
points AS (SELECT unnest([0.5, 0.95, 0.99]) AS q),
hit AS (SELECT t_ms, q, CASE WHEN b IS NULL THEN lo ELSE lo + (b - lo) * coalesce((q * n - below) / nullif(cum - below, 0), 0) END AS v FROM steps, points
  WHERE cum >= q * n - 1e-15 QUALIFY row_number() OVER (PARTITION BY t_ms, q ORDER BY b NULLS LAST) = 1)"""


@query(
    "high_prediction_latency",
    "requests",
    _RATES_SQL + ", s AS (SELECT t_ms, v / 1000 AS value FROM hit WHERE q = 0.99)," + hold_sql("s", "value > 0.05", 120_000),
)
def _high_prediction_latency(spark, sf_dir):
    return _states(P.high_prediction_latency(requests(spark, sf_dir), (), HOUR_MS, 6 * HOUR_MS))


@query(
    "latency_panel",
    "requests",
    _RATES_SQL
    + """, wide AS (SELECT t_ms, max(v) FILTER (q = 0.5) AS p50, max(v) FILTER (q = 0.95) AS p95, max(v) FILTER (q = 0.99) AS p99 FROM hit GROUP BY ALL)
SELECT t_ms, round(p50, 6) AS p50, round(p95, 6) AS p95, round(p99, 6) AS p99,
  CASE WHEN p99 >= 30 THEN 'red' WHEN p99 >= 20 THEN 'yellow' ELSE 'green' END AS band FROM wide""",
)
def _latency_panel(spark, sf_dir):
    out = P.latency_panel(requests(spark, sf_dir), HOUR_MS, 6 * HOUR_MS)
    return out.select("t_ms", r6("p50", "p50"), r6("p95", "p95"), r6("p99", "p99"), "band")


@query(
    "high_prediction_errors",
    "requests",
    """
WITH counted AS (SELECT source, ms, max_by(no % 1000, event_id)::double AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY ms, event_id) AS no FROM requests WHERE status <> 'success') GROUP BY ALL),
steps AS (SELECT *, value - lag(value) OVER (PARTITION BY source ORDER BY ms) AS d FROM counted),
gains AS (SELECT *, CASE WHEN d >= 0 THEN d WHEN d < 0 THEN value ELSE 0 END AS inc FROM steps),
s AS (SELECT source, ms AS t_ms, sum(inc) OVER (PARTITION BY source ORDER BY ms RANGE BETWEEN 299999 PRECEDING AND CURRENT ROW) / 300 AS value FROM gains),"""
    + hold_sql("s", "value > 0.1", 120_000, "source", gap_ms=300_000),
)
def _high_prediction_errors(spark, sf_dir):
    """Over the counter of failed requests."""
    return _states(P.high_prediction_errors(counter(spark, sf_dir, failed_only=True), ["source"]), "source")


_LAG_SQL = """
WITH moves AS (SELECT source_partition, ceil(event_ms / 60000)::bigint * 60000 AS t_ms, 1 AS d FROM vitals
  UNION ALL SELECT source_partition, ceil(arrival_ms / 60000)::bigint * 60000, -1 FROM vitals),
steps AS (SELECT source_partition, t_ms, sum(d) AS d FROM moves GROUP BY ALL),
lag_ AS (SELECT source_partition, t_ms, (sum(d) OVER (PARTITION BY source_partition ORDER BY t_ms))::double AS value FROM steps),"""

# The given tables never lag by a thousand rows; a lower limit shows all three states.
_LOW_LAG = A.AlertRule("KafkaConsumerLag", 0, 60_000, "critical", "A partition lags by %.0f messages")


@query("source_lag", "vitals", _LAG_SQL[: _LAG_SQL.rindex(",")] + "\nSELECT * FROM lag_")
def _source_lag(spark, sf_dir):
    return P.source_lag(vitals(spark, sf_dir))


@query("partition_lag_alert", "vitals", _LAG_SQL + hold_sql("lag_", "value > 0", 60_000, "source_partition", gap_ms=300_000))
def _partition_lag_alert(spark, sf_dir):
    return _states(P.partition_lag_alert(P.source_lag(vitals(spark, sf_dir)), rule=_LOW_LAG), "source_partition")


@query(
    "high_lag",
    "vitals",
    _LAG_SQL + "s AS (SELECT t_ms, sum(value) AS value FROM lag_ GROUP BY ALL)," + hold_sql("s", "value > 1000", 300_000, gap_ms=300_000),
)
def _high_lag(spark, sf_dir):
    return _states(P.high_lag(P.source_lag(vitals(spark, sf_dir))))


_DAILY = f"""
WITH m AS (SELECT event_ms // 86400000 * 86400000 AS t_ms, avg(age) AS age, avg(bmi) AS bmi, avg(glucose_level) * 1.8 AS glucose_level
  FROM vitals GROUP BY ALL HAVING count(*) >= 100),
s AS (SELECT t_ms, ({_shift_of("m")} > 0.2)::int::double AS value FROM m),"""


@query("data_drift_detected", "vitals reference", _DAILY + hold_sql("s", "value > 0", 300_000, gap_ms=DAY_MS))
def _data_drift_detected(spark, sf_dir):
    """Glucose readings in another unit make every day drift."""
    rows = vitals(spark, sf_dir).withColumn("glucose_level", F.col("glucose_level") * 1.8)
    return _states(P.data_drift_detected(rows, reference(spark, sf_dir), DRIFT_COLUMNS, DAY_MS))


@query("high_late_ratio", "vitals", _LATE_BY_HOUR + hold_sql("s", "value > 0.1", 300_000))
def _high_late_ratio(spark, sf_dir):
    return _states(P.high_late_ratio(vitals(spark, sf_dir), HOUR_MS))


@query(
    "throughput_panel",
    "requests",
    """
WITH steps AS (SELECT ceil(ms / 3600000)::bigint * 3600000 AS t_ms, count(*) AS n, count(*) FILTER (status <> 'success') AS bad FROM requests GROUP BY ALL),
times AS (SELECT DISTINCT t_ms + k * 3600000 AS moment FROM steps, range(0, 7) r(k))
SELECT moment AS t_ms, round(coalesce((SELECT sum(n) FROM steps s WHERE s.t_ms <= moment AND s.t_ms > moment - 21600000), 0) / 21600, 9) AS predictions_per_sec,
  round(coalesce((SELECT sum(bad) FROM steps s WHERE s.t_ms <= moment AND s.t_ms > moment - 21600000), 0) / 21600, 9) AS errors_per_sec FROM times""",
)
def _throughput_panel(spark, sf_dir):
    out = P.throughput_panel(requests(spark, sf_dir), HOUR_MS, 6 * HOUR_MS)
    return out.withColumns({c: F.round(c, 9) for c in ("predictions_per_sec", "errors_per_sec")})


@query(
    "lag_panel",
    "vitals",
    _LAG_SQL
    + """
groups AS (SELECT * FROM lag_ WHERE source_partition < 2),
g AS (SELECT t_ms, sum(value) AS value FROM groups GROUP BY ALL), a AS (SELECT t_ms, sum(value) AS value FROM lag_ GROUP BY ALL),
e AS (SELECT arrival_ms // 60000 * 60000 AS t_ms, max(arrival_ms - event_ms)::double AS value FROM vitals GROUP BY ALL)
SELECT 'total_lag' AS series, * FROM (FROM g UNION ALL SELECT * FROM a ANTI JOIN g USING (t_ms))
UNION ALL SELECT 'group_lag', t_ms, sum(value) FROM groups WHERE source_partition = 1 GROUP BY ALL
UNION ALL SELECT 'event_time_lag_ms', * FROM e UNION ALL SELECT 'event_time_lag_s', t_ms, value / 1000 FROM e""",
)
def _lag_panel(spark, sf_dir):
    """Partitions 0 and 1 report as consumer groups too; elsewhere the sum over partitions steps in."""
    rows = vitals(spark, sf_dir)
    lag = stage(P.source_lag(rows), "source-lag")
    groups = lag.where(F.col("source_partition") < 2).withColumn("consumer_group", F.concat(F.lit("group-"), F.col("source_partition")))
    return P.lag_panel(groups, lag, P.lag_series(rows), "group-1")


@query(
    "quality_panel",
    "vitals reference",
    f"""
WITH m AS (SELECT event_ms // 86400000 * 86400000 AS t_ms, count(*) AS n, avg(age) AS age, avg(bmi) AS bmi, avg(glucose_level) AS glucose_level,
  count(*) FILTER (arrival_ms - event_ms > 300000) AS late FROM vitals GROUP BY ALL),
d AS (SELECT t_ms, n, late, late / n AS ratio, CASE WHEN n >= 100 THEN {_shift_of("m")} END AS score FROM m)
SELECT t_ms, round(score, 6) AS drift_score, (score > 0.2)::int::bigint AS drift_detected,
  CASE WHEN score >= 0.2 THEN 'red' WHEN score >= 0.1 THEN 'yellow' WHEN score IS NOT NULL THEN 'green' END AS drift_band,
  round(ratio, 6) AS late_data_ratio, round(late / 86400, 9) AS late_per_sec,
  CASE WHEN ratio >= 0.1 THEN 'red' WHEN ratio >= 0.05 THEN 'yellow' ELSE 'green' END AS late_band FROM d""",
)
def _quality_panel(spark, sf_dir):
    out = P.quality_panel(vitals(spark, sf_dir), reference(spark, sf_dir), DRIFT_COLUMNS, DAY_MS)
    return out.withColumns({"drift_score": F.round("drift_score", 6), "late_data_ratio": F.round("late_data_ratio", 6), "late_per_sec": F.round("late_per_sec", 9)})


@query(
    "risk_gauge",
    "scored",
    """
SELECT discharge_destination, round(r, 6) AS risk_score, CASE WHEN r >= 0.7 THEN 'red' WHEN r >= 0.5 THEN 'yellow' ELSE 'green' END AS band
FROM (SELECT discharge_destination, max_by(risk, (event_ms, event_id)) AS r FROM scored GROUP BY ALL)""",
)
def _risk_gauge(spark, sf_dir):
    return P.risk_gauge(score_vitals(vitals(spark, sf_dir)), ["discharge_destination"]).withColumn("risk_score", F.round("risk_score", 6))

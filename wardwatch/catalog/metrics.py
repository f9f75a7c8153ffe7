"""Request metrics, counters, training data and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardwatch.catalog.history import SMALL_CHUNK
from wardwatch.catalog.registry import LOGIT, query, r6
from wardwatch.fixtures import counter, current, reference, requests, vitals
from wardwatch.operators import requests as R
from wardwatch.operators import training as T
from wardwatch.schemas import FEATURE_ORDER
from wardwatch.session import stage
from wardwatch.operators.drift import mean_shift_drift
from wardwatch.operators.lateness import late_counts, late_ratio
from wardwatch.operators.reconcile import metric_or
from wardwatch.operators.scoring import RISK_FACTOR_MODEL, score_vitals
from wardwatch.session import work_dir
from wardwatch.sinks.tables import as_metrics, emit_metrics, read_metrics

_LATENCIES = """round(coalesce(quantile_cont(latency_ms, 0.5) FILTER (status = 'success'), 0), 6) AS p50_ms,
  round(coalesce(quantile_cont(latency_ms, 0.95) FILTER (status = 'success'), 0), 6) AS p95_ms,
  round(coalesce(quantile_cont(latency_ms, 0.99) FILTER (status = 'success'), 0), 6) AS p99_ms,
  round(coalesce(avg(latency_ms) FILTER (status = 'success'), 0), 6) AS avg_latency_ms,
  coalesce(min(latency_ms) FILTER (status = 'success'), 0) AS min_latency_ms,
  coalesce(max(latency_ms) FILTER (status = 'success'), 0) AS max_latency_ms,
  round(avg((status <> 'success')::int), 6) AS error_rate, count(*) FILTER (status <> 'success') AS error_count,
  count(*) FILTER (status = 'success') AS successful_requests, count(*) AS total_requests"""


def _rounded(df, *names):
    return df.withColumns({c: F.round(c, 6) for c in names})


_MEASURED = ("p50_ms", "p95_ms", "p99_ms", "avg_latency_ms", "error_rate")


@query("latency_summary", "requests", f"SELECT {_LATENCIES} FROM requests")
def _latency_summary(spark, sf_dir):
    return _rounded(R.latency_summary(requests(spark, sf_dir)), *_MEASURED)


@query("latency_summary_by_source", "requests", f"SELECT source, {_LATENCIES} FROM requests GROUP BY ALL")
def _latency_summary_by_source(spark, sf_dir):
    return _rounded(R.latency_summary(requests(spark, sf_dir), ["source"]), *_MEASURED)


@query("latency_summary_split", "requests", f"SELECT source, {_LATENCIES} FROM requests GROUP BY ALL")
def _latency_summary_split(spark, sf_dir):
    return _rounded(R.latency_summary(requests(spark, sf_dir), ["source"], rows_per_chunk=SMALL_CHUNK), *_MEASURED)


@query(
    "latency_sketches",
    "requests",
    """
SELECT source, q.point, n, lowest, highest, true AS within FROM (
  SELECT source, count(*) AS n, min(latency_ms) AS lowest, max(latency_ms) AS highest FROM requests WHERE status = 'success' GROUP BY ALL),
  (VALUES ('p50_ms'), ('p95_ms'), ('p99_ms')) q(point)""",
)
def _latency_sketches(spark, sf_dir):
    """Sketches by hour are stored and merged; `within` holds their percentiles' exact ranks to the promised error."""
    rows = requests(spark, sf_dir)
    stored = stage(R.latency_sketches(rows, step_ms=3_600_000), "latency-sketches")
    merged = R.latency_between(stored).unpivot(["source", "n", "lowest", "highest"], [*R.PERCENTILE_POINTS], "point", "value")
    # Three rows per source; each success is counted for each of them before the shuffle.
    good = rows.where(F.col("status") == "success").select("source", "latency_ms").join(merged, "source")
    below, upto = F.avg((F.col("latency_ms") < F.col("value")).cast("int")), F.avg((F.col("latency_ms") <= F.col("value")).cast("int"))
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in R.PERCENTILE_POINTS.items() for x in pair]), F.col("point"))
    within = (below <= wanted + 0.01) & (upto >= wanted - 0.01)
    return good.groupBy("source", "point", "n", "lowest", "highest").agg(within.alias("within"))


@query(
    "slo_check",
    "requests",
    "SELECT source, round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms, quantile_cont(latency_ms, 0.99) < 30 AS passed FROM requests WHERE status = 'success' GROUP BY ALL",
)
def _slo_check(spark, sf_dir):
    good = requests(spark, sf_dir).where(F.col("status") == "success")
    return R.slo_check(R.latency_summary(good, ["source"])).select("source", r6("p99_ms", "p99_ms"), "passed")


@query("error_rate", "requests", "SELECT source, round(avg((status <> 'success')::int), 6) AS error_rate FROM requests GROUP BY ALL")
def _error_rate(spark, sf_dir):
    return _rounded(R.error_rate(requests(spark, sf_dir), ["source"]), "error_rate")


@query(
    "error_breakdown",
    "requests",
    "SELECT status, count(*) AS n, round(avg(latency_ms), 6) AS avg_latency_ms FROM requests WHERE status <> 'success' GROUP BY ALL",
)
def _error_breakdown(spark, sf_dir):
    return _rounded(R.error_breakdown(requests(spark, sf_dir)), "avg_latency_ms")


@query("labelled_counts", "requests", "SELECT source, status, count(*) AS n FROM requests GROUP BY ALL")
def _labelled_counts(spark, sf_dir):
    return R.labelled_counts(requests(spark, sf_dir), ["source", "status"])


@query("non_empty_latency", "requests", "SELECT source, count(*) AS n, min(latency_ms) AS smallest FROM requests WHERE latency_ms > 0 GROUP BY ALL")
def _non_empty_latency(spark, sf_dir):
    return R.non_empty_latency(requests(spark, sf_dir)).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("latency_ms").alias("smallest"))


_BUCKET_SQL = """
WITH les AS (SELECT unnest([1, 2, 5, 10, 20, 30, 50, 100, 200, 500, 1000, NULL]) AS b),
hist AS (SELECT source, b, count(*) FILTER (b IS NULL OR latency_ms <= b) AS cum, sum(latency_ms) AS total, count(*) AS n FROM requests, les GROUP BY ALL)"""


@query(
    "latency_histogram",
    "requests",
    _BUCKET_SQL + "SELECT source, coalesce(b::varchar, '+Inf') AS le, cum, round(total, 4) AS sum, n AS count FROM hist",
)
def _latency_histogram(spark, sf_dir):
    return R.latency_histogram(requests(spark, sf_dir), ["source"]).withColumn("sum", F.round("sum", 4))


@query(
    "histogram_quantile",
    "requests",
    _BUCKET_SQL
    + """, steps AS (
  SELECT *, coalesce(lag(b) OVER w, 0) AS lo, coalesce(lag(cum) OVER w, 0) AS below FROM hist WINDOW w AS (PARTITION BY source ORDER BY b NULLS LAST)),
points AS (SELECT unnest([0.5, 0.95, 0.99]) AS q),
hit AS (SELECT source, q, CASE WHEN b IS NULL THEN lo ELSE lo + (b - lo) * (q * n - below) / (cum - below) END AS v FROM steps, points
  WHERE cum >= q * n QUALIFY row_number() OVER (PARTITION BY source, q ORDER BY b NULLS LAST) = 1)
SELECT source, round(max(v) FILTER (q = 0.5), 6) AS p50, round(max(v) FILTER (q = 0.95), 6) AS p95, round(max(v) FILTER (q = 0.99), 6) AS p99
FROM hit GROUP BY ALL""",
)
def _histogram_quantile(spark, sf_dir):
    hist = R.latency_histogram(requests(spark, sf_dir), ["source"])
    buckets = hist.select("source", F.when(F.col("le") != R.INFINITY, F.col("le")).cast("double").alias("le"), F.col("cum").cast("double").alias("cum"))
    return _rounded(R.histogram_quantiles(buckets, ["source"], {"p50": 0.5, "p95": 0.95, "p99": 0.99}), "p50", "p95", "p99")


@query("last_gauge", "requests", "SELECT source, max_by(latency_ms, (ms, event_id)) AS latency_ms FROM requests GROUP BY ALL")
def _last_gauge(spark, sf_dir):
    return R.last_gauge(requests(spark, sf_dir), ["source"], "latency_ms", ["ms", "event_id"])


@query("sum_series", "requests", "SELECT ms // 86400000 AS day, round(sum(latency_ms), 4) AS value FROM requests GROUP BY ALL")
def _sum_series(spark, sf_dir):
    days = requests(spark, sf_dir).select(F.floor(F.col("ms") / 86_400_000).alias("day"), F.col("latency_ms").alias("value"))
    return R.sum_series(days, ["day"]).withColumn("value", F.round("value", 4))


_RATE_SQL = """
WITH steps AS (SELECT *, value - lag(value) OVER (PARTITION BY source ORDER BY ms) AS d FROM counter),
gains AS (SELECT *, CASE WHEN d >= 0 THEN d WHEN d < 0 THEN value ELSE 0 END AS inc FROM steps)
SELECT source, ms, round(sum(inc) OVER (PARTITION BY source ORDER BY ms RANGE BETWEEN {r} PRECEDING AND CURRENT ROW) / {s}, 9) AS rate FROM gains"""


@query("counter_rate", "counter", _RATE_SQL.format(r=299_999, s=300))
def _counter_rate(spark, sf_dir):
    return R.counter_rate(counter(spark, sf_dir), ["source"]).withColumn("rate", F.round("rate", 9))


@query("counter_rate_split", "counter", _RATE_SQL.format(r=21_599_999, s=21_600))
def _counter_rate_split(spark, sf_dir):
    return R.counter_rate(counter(spark, sf_dir), ["source"], 21_600_000, SMALL_CHUNK).withColumn("rate", F.round("rate", 9))


@query(
    "count_rate",
    "requests",
    """
WITH steps AS (SELECT source, ceil(ms / 3600000)::bigint * 3600000 AS t_ms, count(*) AS n FROM requests GROUP BY ALL),
times AS (SELECT DISTINCT source, t_ms + k * 3600000 AS moment FROM steps, range(0, 7) r(k))
SELECT source, moment AS t_ms, round(coalesce(sum(n), 0) / 21600, 9) AS rate
FROM times t LEFT JOIN steps s USING (source) WHERE s.t_ms <= moment AND s.t_ms > moment - 21600000 GROUP BY ALL
UNION ALL SELECT source, moment, 0 FROM times t WHERE NOT EXISTS (FROM steps s WHERE s.source = t.source AND s.t_ms <= moment AND s.t_ms > moment - 21600000)""",
)
def _count_rate(spark, sf_dir):
    return R.count_rate(requests(spark, sf_dir), ["source"], 3_600_000, 21_600_000).withColumn("rate", F.round("rate", 9))


@query(
    "rolling_percentiles",
    "requests",
    """
WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ms, event_id) AS no FROM requests WHERE latency_ms > 0),
ends AS (SELECT source, max(no) AS n FROM numbered GROUP BY source),
reports AS (SELECT source, n, unnest(range(1, (n + 499) // 500 + 1)) AS report FROM ends)
SELECT source, report, round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms, round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms,
  round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms, round(avg(latency_ms), 6) AS avg_latency_ms
FROM reports JOIN numbered USING (source) WHERE no <= least(report * 500, n) AND no > least(report * 500, n) - 1000 GROUP BY ALL""",
)
def _rolling_percentiles(spark, sf_dir):
    out = R.rolling_percentiles(requests(spark, sf_dir), ["source"], every=500)
    return _rounded(out, "p50_ms", "p95_ms", "p99_ms", "avg_latency_ms")


@query("first_errors", "requests", "SELECT * FROM requests WHERE status <> 'success' ORDER BY ms, event_id LIMIT 100")
def _first_errors(spark, sf_dir):
    return R.first_errors(requests(spark, sf_dir))


@query(
    "metric_or",
    "requests",
    """
WITH good AS (SELECT source, ms // 3600000 AS hour, count(*)::double AS value FROM requests WHERE status = 'success' GROUP BY ALL),
every AS (SELECT source, ms // 3600000 AS hour, -count(*)::double AS value FROM requests GROUP BY ALL)
FROM good UNION ALL SELECT * FROM every ANTI JOIN good USING (source, hour)""",
)
def _metric_or(spark, sf_dir):
    hours = requests(spark, sf_dir).withColumn("hour", F.floor(F.col("ms") / 3_600_000))
    good = hours.where(F.col("status") == "success").groupBy("source", "hour").agg(F.count(F.lit(1)).cast("double").alias("value"))
    every = hours.groupBy("source", "hour").agg((-F.count(F.lit(1))).cast("double").alias("value"))
    return metric_or(good, every, ["source", "hour"])


@query(
    "emit_metrics",
    "vitals reference current_",
    """
WITH late AS (SELECT count(*)::double AS total_data_count, count(*) FILTER (arrival_ms - event_ms > 300000)::double AS late_data_count, max(arrival_ms) AS ts_ms FROM vitals),
shift AS (SELECT least(abs((SELECT avg(bmi) FROM current_) - (SELECT avg(bmi) FROM reference)) / (SELECT avg(bmi) FROM reference), 1) AS s)
SELECT metric, job, ts_ms, round(value, 6) AS value FROM (
  SELECT 'total_data_count' AS metric, 'vitals' AS job, ts_ms, total_data_count AS value FROM late
  UNION ALL SELECT 'late_data_count', 'vitals', ts_ms, late_data_count FROM late
  UNION ALL SELECT 'late_data_ratio', 'vitals', ts_ms, late_data_count / total_data_count FROM late
  UNION ALL SELECT 'data_drift_score', 'data_drift', ts_ms, s FROM late, shift
  UNION ALL SELECT 'data_drift_detected', 'data_drift', ts_ms, (s > 0.2)::int FROM late, shift)""",
)
def _emit_metrics(spark, sf_dir):
    rows = vitals(spark, sf_dir)
    at = rows.agg(F.max("arrival_ms")).first()[0]
    late = as_metrics(late_ratio(late_counts(rows)), ["total_data_count", "late_data_count", "late_data_ratio"], "vitals", F.lit(at))
    drift = mean_shift_drift(reference(spark, sf_dir), current(spark, sf_dir), ["bmi"])
    drift = drift.select(F.col("drift_score").alias("data_drift_score"), F.col("drift_detected").cast("int").alias("data_drift_detected"))
    path = work_dir(spark, "metrics")
    emit_metrics(late, path)
    emit_metrics(as_metrics(drift, drift.columns, "data_drift", F.lit(at)), path)
    return read_metrics(spark, path).select("metric", F.col("labels")["job"].alias("job"), "ts_ms", r6("value", "value"))


_SPLIT_SQL = """
WITH ranked AS (SELECT event_id, readmitted_30_days, row_number() OVER (PARTITION BY readmitted_30_days ORDER BY md5(event_id::varchar), event_id) AS k,
  count(*) OVER (PARTITION BY readmitted_30_days) AS n FROM vitals)
SELECT event_id, readmitted_30_days, k <= ceil(0.2 * n) AS is_test FROM ranked"""


@query("stratified_split", "vitals", _SPLIT_SQL)
def _stratified_split(spark, sf_dir):
    return T.stratified_split(vitals(spark, sf_dir).select("event_id", "readmitted_30_days"), "event_id")


@query("stratified_split_large", "vitals", _SPLIT_SQL)
def _stratified_split_large(spark, sf_dir):
    return T.stratified_split(vitals(spark, sf_dir).select("event_id", "readmitted_30_days"), "event_id", digits=1)


@query(
    "sample_rows",
    "vitals",
    "SELECT event_id, patient_id FROM vitals ORDER BY md5(concat(event_id::varchar, ':42')), event_id LIMIT 1000",
)
def _sample_rows(spark, sf_dir):
    return T.sample_rows(vitals(spark, sf_dir).select("event_id", "patient_id"), 1000)


@query(
    "classification_report",
    "scored",
    f"""
WITH pairs AS (SELECT (readmitted_30_days = 'Yes')::int AS y, (error IS NULL AND {LOGIT} > 0)::int AS p FROM scored),
per AS (SELECT c, count(*) FILTER (y = c AND p = c) AS hit, count(*) FILTER (p = c) AS predicted, count(*) FILTER (y = c) AS support
  FROM pairs, (VALUES (0), (1)) v(c) GROUP BY c),
m AS (SELECT c, coalesce(hit / nullif(predicted, 0), 0) AS pr, coalesce(hit / nullif(support, 0), 0) AS re, support::double AS support FROM per),
f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM m),
a AS (SELECT avg((y = p)::int) AS acc, count(*)::double AS n FROM pairs)
SELECT class, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1, support FROM (
  SELECT c::varchar AS class, pr, re, f1, support FROM f
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM a
  UNION ALL SELECT 'macro avg', avg(pr), avg(re), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f)""",
)
def _classification_report(spark, sf_dir):
    scored = T.predict_label(score_vitals(vitals(spark, sf_dir)), RISK_FACTOR_MODEL, F.col("features"))
    labelled = scored.withColumn("readmitted_30_days", (F.col("readmitted_30_days") == "Yes").cast("int"))
    return _rounded(T.classification_report(labelled), "precision", "recall", "f1")


@query(
    "rank_coefficients",
    "",
    f"SELECT feature, true AS in_order, true AS settled FROM (SELECT unnest({list(FEATURE_ORDER)!r}) AS feature)",
)
def _rank_coefficients(spark, sf_dir):
    """Trains on the training part. SQL has no optimiser, but knows what holds at its end: the penalised loss has no slope
    along any feature, and the features come in the order of their coefficients' size."""
    rows = T.prepare_training(vitals(spark, sf_dir), ["event_id"]).dropna(subset=[*FEATURE_ORDER, T.LABEL])
    train = stage(T.stratified_split(rows, "event_id").where(~F.col("is_test")), "training-part")
    model = T.as_risk_model(T.train_risk_model(train))
    ranked = [r.feature for r in T.rank_coefficients(spark, model).collect()]
    sizes = [abs(model.weights[name]) for name in ranked]
    order = {name: all(size <= before for before in sizes[:i]) for i, (name, size) in enumerate(zip(ranked, sizes))}
    off = 1 / (1 + F.exp(-model.logit(F.struct(*FEATURE_ORDER)))) - F.col(T.LABEL)
    slopes = [(F.avg(off * F.col(c)) + model.weights[c] / F.count(off)) / F.greatest(F.avg(F.abs(F.col(c))), F.lit(1.0)) for c in FEATURE_ORDER]
    slope = train.agg(*[s.alias(c) for c, s in zip(FEATURE_ORDER, slopes)]).unpivot([], list(FEATURE_ORDER), "feature", "slope")
    placed = spark.createDataFrame(list(order.items()), "feature STRING, in_order BOOLEAN")
    return slope.join(placed, "feature").select("feature", "in_order", (F.abs("slope") < 1e-3).alias("settled"))

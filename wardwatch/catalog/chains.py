"""Whole chains over the given tables: what is written, saved or stopped is read, loaded or started again."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardwatch.catalog.quality import _SHIFT_PARTS
from wardwatch.catalog.registry import query, r6
from wardwatch.catalog.streams import _sliced, _vitals_stream
from wardwatch.fixtures import current, reference, requests, vitals
from wardwatch.functions.records import project_prediction
from wardwatch.operators import drift as D
from wardwatch.operators import requests as R
from wardwatch.operators import training as T
from wardwatch.operators.scoring import score_request, successful_only
from wardwatch.plans import alerting as P
from wardwatch.schemas import FEATURE_ORDER, PATIENTS_CSV
from wardwatch.session import stage, work_dir
from wardwatch.sinks.tables import emit_metrics, read_metrics, write_batch, write_predictions, write_report
from wardwatch.sources.models import load_model, save_model
from wardwatch.sources.vitals import event_time_error, predictions_table, vitals_stream, vitals_table
from wardwatch.streaming import queries as S


@query(
    "json_files_stream",
    "vitals",
    "SELECT event_id, patient_id, age, blood_pressure, round(glucose_level, 6) AS glucose_level, round(bmi, 6) AS bmi, event_ms FROM vitals",
)
def _json_files_stream(spark, sf_dir):
    """Vitals as lines of JSON text, read as a stream, and written again."""
    base = work_dir(spark, "json-stream")
    rows = vitals(spark, sf_dir).drop("ts", "readmitted_30_days", "arrival_ms").withColumnRenamed("event_ms", "timestamp")
    write_predictions(rows, f"{base}/in")
    stream = vitals_stream(spark, f"{base}/in", "text", files_per_trigger=1)
    S.run_available(stream, S.table_writer(f"{base}/out"), f"{base}/checkpoint")
    out = spark.read.parquet(f"{base}/out")
    return out.select("event_id", "patient_id", "age", "blood_pressure", r6("glucose_level", "glucose_level"), r6("bmi", "bmi"), "event_ms")


@query(
    "event_time_error",
    "vitals",
    """
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'missing_event_time' WHEN event_id % 77 = 0 THEN 'event_time_ahead' END AS error FROM vitals""",
)
def _event_time_error(spark, sf_dir):
    rows = vitals(spark, sf_dir)
    late = F.when(F.col("event_id") % 77 == 0, F.col("arrival_ms") + 300_001).otherwise(F.col("event_ms"))
    moved = rows.withColumn("event_ms", F.when(F.col("event_id") % 50 != 0, late))
    return event_time_error(moved).select("event_id", "error")


@query(
    "predictions_table",
    "judged",
    "SELECT patient_id, round(risk, 4) AS risk_score, anomaly, (event_id % 3)::integer AS batch_id FROM judged WHERE error IS NULL",
)
def _predictions_table(spark, sf_dir):
    """Three batches, one of them written twice, are read as one table."""
    path = work_dir(spark, "predictions")
    scored = stage(project_prediction(successful_only(score_request(vitals(spark, sf_dir))), keep=("event_id",)), "scored")
    for batch in (0, 1, 2, 1):
        write_batch(scored.where(F.col("event_id") % 3 == batch), path, batch)
    return predictions_table(spark, path).select("patient_id", "risk_score", "anomaly", "batch_id")


@query(
    "write_report",
    "requests",
    """
SELECT (SELECT count(*) FROM requests) AS total_requests, (SELECT count(*) FROM requests WHERE status <> 'success') AS error_count,
  count(*) AS n_errors, min(event_id) AS first_error, round(sum(latency_ms), 6) AS latency_sum
FROM (SELECT * FROM requests WHERE status <> 'success' ORDER BY ms, event_id LIMIT 100)""",
)
def _write_report(spark, sf_dir):
    path = work_dir(spark, "report")
    rows = requests(spark, sf_dir)
    write_report(R.latency_summary(rows), R.first_errors(rows), path)
    summary = spark.read.json(f"{path}/metrics").select("total_requests", "error_count")
    errors = spark.read.json(f"{path}/errors").agg(F.count("*").alias("n_errors"), F.min("event_id").alias("first_error"), r6(F.sum("latency_ms"), "latency_sum"))
    return summary.crossJoin(errors)  # one row each


_NUMBERS = ("event_id", "event_ms", "arrival_ms", "source_partition", "age", "glucose_level", "cholesterol", "bmi", "medication_count", "length_of_stay")


@query(
    "numeric_columns",
    "vitals",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg({c}), 3) AS mean FROM vitals" for c in _NUMBERS),
)
def _numeric_columns(spark, sf_dir):
    """Without a list, every number but the patient's is averaged."""
    return D.column_means(vitals(spark, sf_dir)).withColumn("mean", F.round("mean", 3))


@query(
    "common_columns",
    "reference current_",
    f"""SELECT "column", round(least(abs(cur_mean - ref_mean) / abs(ref_mean), 1), 6) AS shift FROM ({_SHIFT_PARTS}) WHERE "column" <> 'bmi'""",
)
def _common_columns(spark, sf_dir):
    """Columns that one side lacks or holds as text are not compared."""
    ref = reference(spark, sf_dir).select("patient_id", "age", "glucose_level", "bmi", "gender")
    cur = current(spark, sf_dir).select("patient_id", "age", "glucose_level", "gender", "cholesterol")
    return D.column_shifts(ref, cur).select("column", r6("shift", "shift"))


@query("restarted_stream", "vitals", "SELECT event_id, patient_id, event_ms FROM vitals")
def _restarted_stream(spark, sf_dir):
    """A query that fails in its third batch goes on from its checkpoint; nothing is lost or there twice."""
    base = work_dir(spark, "restart")
    write = S.table_writer(f"{base}/events", lambda df: df.select("event_id", "patient_id", "event_ms"))

    def failing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("stopped on purpose")

    _sliced(spark, sf_dir, "event_ms")
    try:
        S.run_available(_vitals_stream(spark, sf_dir), failing, f"{base}/checkpoint")
    except Exception as error:
        if "stopped on purpose" not in str(error):
            raise
    S.run_available(_vitals_stream(spark, sf_dir), write, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/events").drop("batch_id")


@query(
    "training_chain",
    "vitals",
    f"""
WITH ranked AS (SELECT readmitted_30_days AS y, row_number() OVER (PARTITION BY readmitted_30_days ORDER BY md5(event_id::varchar), event_id) AS k,
  count(*) OVER (PARTITION BY readmitted_30_days) AS n FROM vitals WHERE blood_pressure <> 'n/a'),
sizes AS (SELECT count(*) FILTER (k > ceil(0.2 * n)) AS n_train, count(*) FILTER (k <= ceil(0.2 * n)) AS n_held_out FROM ranked)
SELECT feature, true AS settled, n_train, n_held_out FROM sizes, (SELECT unnest({[*FEATURE_ORDER, "intercept"]!r}) AS feature)""",
)
def _training_chain(spark, sf_dir):
    """Fit on the training part, save, load, and score both parts. At the fit the penalised loss has no slope
    in any direction; the held-out part is as large as its share of each label."""
    rows = T.prepare_training(vitals(spark, sf_dir), ["event_id"]).dropna(subset=[*FEATURE_ORDER, T.LABEL])
    parts = stage(T.stratified_split(rows, "event_id"), "training-parts")
    train = parts.where(~F.col("is_test"))
    path = work_dir(spark, "model")
    save_model(spark, T.train_risk_model(train), path)
    model = load_model(spark, path)
    n = train.count()
    p = 1 / (1 + F.exp(-model.logit(F.struct(*FEATURE_ORDER))))
    off = p - F.col(T.LABEL)
    slopes = [(F.avg(off * F.col(c)) + model.weights[c] / n) / F.greatest(F.avg(F.abs(F.col(c))), F.lit(1.0)) for c in FEATURE_ORDER]
    sums = train.agg(*[s.alias(c) for c, s in zip(FEATURE_ORDER, slopes)], F.avg(off).alias("intercept"))
    slope = sums.unpivot([], [*FEATURE_ORDER, "intercept"], "feature", "slope")
    sizes = parts.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_held_out"))
    return slope.select("feature", (F.abs("slope") < 1e-3).alias("settled")).crossJoin(sizes)  # one row of sizes


_REPORT_NAMES = ["0", "1", "accuracy", "macro avg", "weighted avg"]


@query(
    "held_out_report",
    "vitals",
    f"""
WITH ranked AS (SELECT readmitted_30_days AS y, row_number() OVER (PARTITION BY readmitted_30_days ORDER BY md5(event_id::varchar), event_id) AS k,
  count(*) OVER (PARTITION BY readmitted_30_days) AS n FROM vitals WHERE blood_pressure <> 'n/a'),
held AS (SELECT y FROM ranked WHERE k <= ceil(0.2 * n))
SELECT class, count(*) FILTER (class NOT IN ('0', '1') OR (y = 'Yes')::int::varchar = class)::double AS support, true AS recomputed, true AS better_than_turned
FROM held, (SELECT unnest({_REPORT_NAMES!r}) AS class) GROUP BY ALL""",
)
def _held_out_report(spark, sf_dir):
    """The whole report of the fitted model on rows that it was not fitted on.

    SQL cannot fit, so it checks whom the report judges. Each line's precision, recall and F1 are recomputed in plain SQL from the
    scored rows, and the model must beat the one that says the opposite of it.
    """
    rows = T.prepare_training(vitals(spark, sf_dir), ["event_id"]).dropna(subset=[*FEATURE_ORDER, T.LABEL])
    parts = stage(T.stratified_split(rows, "event_id"), "training-parts")
    model = T.as_risk_model(T.train_risk_model(parts.where(~F.col("is_test"))))
    scored = stage(T.predict_label(parts.where("is_test"), model, F.struct(*FEATURE_ORDER)), "held-out-scored")
    report = T.classification_report(scored)
    again = spark.sql(
        """
WITH s AS (SELECT readmitted_30_days AS y, prediction AS p FROM {scored}),
c AS (SELECT k, count_if(y = k) AS n, coalesce(try_divide(count_if(y = k AND p = k), count_if(p = k)), 0) AS pr,
  coalesce(try_divide(count_if(y = k AND p = k), count_if(y = k)), 0) AS re FROM s, (SELECT explode(array(0, 1)) AS k) GROUP BY k),
f AS (SELECT *, coalesce(try_divide(2 * pr * re, pr + re), 0) AS f1 FROM c)
SELECT cast(k AS string) AS name, pr, re, f1 FROM f
UNION ALL SELECT 'accuracy', avg(int(y = p)), avg(int(y = p)), avg(int(y = p)) FROM s
UNION ALL SELECT 'macro avg', avg(pr), avg(re), avg(f1) FROM f
UNION ALL SELECT 'weighted avg', sum(pr * n) / sum(n), sum(re * n) / sum(n), sum(f1 * n) / sum(n) FROM f""",
        scored=scored,
    )
    right = scored.agg((F.avg((F.col(T.LABEL) == F.col("prediction")).cast("int")) > 0.5).alias("better_than_turned"))
    near = [F.abs(F.col(a) - F.col(b)) < 1e-9 for a, b in (("precision", "pr"), ("recall", "re"), ("f1", "f1_"))]
    both = report.join(again.withColumnRenamed("f1", "f1_"), F.col("class") == F.col("name"))
    return both.select("class", "support", (near[0] & near[1] & near[2]).alias("recomputed")).crossJoin(right)  # one row


@query(
    "vitals_table",
    "vitals",
    """
SELECT user_patient AS patient_id, count(*) AS n, sum(age)::bigint AS ages, min(blood_pressure) AS lowest, round(sum(bmi), 6) AS bmis, max(discharge_destination) AS destination
FROM (SELECT *, patient_id::integer AS user_patient FROM vitals) GROUP BY ALL""",
)
def _vitals_table(spark, sf_dir):
    """Patients as CSV with a header, read as a typed table."""
    path = f"{work_dir(spark, 'patients')}.csv"
    vitals(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType) for f in PATIENTS_CSV.fields]).write.option("header", True).csv(path)
    rows = vitals_table(spark, path)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("age").alias("ages"), F.min("blood_pressure").alias("lowest"), r6(F.sum("bmi"), "bmis")]
    return rows.groupBy("patient_id").agg(*sums, F.max("discharge_destination").alias("destination"))


@query(
    "json_predictions_stream",
    "judged",
    "SELECT event_id, patient_id, round(risk, 4) AS risk_score, anomaly FROM judged WHERE error IS NULL",
)
def _json_predictions_stream(spark, sf_dir):
    """Predictions of a stream as one JSON text per record, the form a topic takes, decoded again."""
    base = work_dir(spark, "json-predictions")
    shape = lambda df: project_prediction(successful_only(score_request(df)), keep=("event_id",))
    S.run_available(_vitals_stream(spark, sf_dir), S.json_writer(f"{base}/records", shape), f"{base}/checkpoint")
    record = "event_id BIGINT, patient_id STRING, risk_score DOUBLE, anomaly BOOLEAN"
    texts = spark.read.option("basePath", f"{base}/records").text(f"{base}/records/batch_id=*")
    return texts.select(F.from_json("value", record).alias("r")).select("r.*")


@query(
    "state_panel",
    "vitals",
    """
WITH m AS (SELECT source_partition::varchar AS query, (event_id % 2)::varchar AS operator, event_ms AS ts_ms, event_ms // 3600000 * 3600000 AS t_ms, event_id, glucose_level AS v FROM vitals),
took AS (SELECT query, t_ms, max(v) / 1000 AS s FROM m GROUP BY ALL),
held AS (SELECT query, operator, t_ms, arg_max(v * 1000, struct_pack(a := ts_ms, b := v)) AS v FROM m GROUP BY ALL),
size AS (SELECT query, t_ms, sum(v) / (1024 * 1024) AS mb FROM held GROUP BY ALL)
SELECT query, t_ms, round(s, 6) AS checkpoint_seconds, round(mb, 6) AS state_mb FROM took JOIN size USING (query, t_ms)""",
)
def _state_panel(spark, sf_dir):
    """The panel over a metric table in the form that a running query writes."""
    labels = F.create_map(F.lit("query"), F.col("source_partition").cast("string"), F.lit("operator"), (F.col("event_id") % 2).cast("string"))
    pairs = F.explode(F.create_map(F.lit("checkpoint_duration_ms"), F.col("glucose_level"), F.lit("state_size_bytes"), F.col("glucose_level") * 1000)).alias("metric", "value")
    rows = vitals(spark, sf_dir).select(labels.alias("labels"), F.col("event_ms").alias("ts_ms"), pairs)
    path = work_dir(spark, "metrics")
    emit_metrics(rows.select("metric", "labels", "ts_ms", "value"), path)
    panel = P.state_panel(read_metrics(spark, path), 3_600_000)
    return panel.withColumns({c: F.round(c, 6) for c in ("checkpoint_seconds", "state_mb")})

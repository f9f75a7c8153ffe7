"""Functions over single events: parsing, pressure, codes, features, scores, records."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardwatch.catalog.registry import query, r6
from wardwatch.fixtures import events, vitals, vitals_with_unknown
from wardwatch.functions import records, scores, timing
from wardwatch.functions import vitals as V
from wardwatch.operators.features import coerce_numeric, featurize, fill_defaults, validate_required
from wardwatch.operators.scoring import (
    RISK_FACTOR_MODEL,
    RiskModel,
    dead_letter,
    model_table,
    score_request,
    score_vitals,
    score_with_model,
    successful_only,
)
from wardwatch.operators.training import label_rate, prepare_training
from wardwatch.plans.pipeline import destination_summary
from wardwatch.plans.sql_functions import register_scoring_functions
from wardwatch.schemas import FEATURE_ORDER, columns
from wardwatch.sources.vitals import arrival_timestamp, event_time_error, parse_vitals, with_arrival


@query(
    "destination_summary",
    "scored",
    """
SELECT discharge_destination, count(*) AS n_events, count(*) FILTER (anomaly) AS n_anomalies,
  count(*) FILTER (risk > 0.7) AS n_high_risk, round(avg(risk) FILTER (error IS NULL), 6) AS mean_risk, count(error) AS n_errors,
  count(*) FILTER (arrival_ms - event_ms > 300000) AS n_late,
  count(*) FILTER (readmitted_30_days = 'Yes') AS n_readmitted
FROM scored GROUP BY ALL""",
)
def _destination_summary(spark, sf_dir):
    out = destination_summary(vitals(spark, sf_dir))
    return out.withColumn("mean_risk", F.round("mean_risk", 6))


@query(
    "parse_vitals",
    "",
    """
SELECT event_type, count(*) AS n, count(k) AS n_k, cast(sum(k) AS bigint) AS sum_k FROM (
  SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS bigint) AS k FROM events
  WHERE json_valid(props) AND json_type(props) = 'OBJECT')
GROUP BY ALL""",
)
def _parse_vitals(spark, sf_dir):
    parsed = parse_vitals(events(spark, sf_dir), "props", columns("k BIGINT"), keep=("event_type",))
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("n_k"), F.sum("k").alias("sum_k"))


@query(
    "with_arrival",
    "vitals",
    "SELECT event_id, strftime(make_timestamp_ms(arrival_ms), '%Y-%m-%d %H:%M:%S') AS arrival, arrival_ms % 1000 AS arrival_part FROM vitals",
)
def _with_arrival(spark, sf_dir):
    """The arrival as a source's timestamp column, and back."""
    sent = arrival_timestamp(vitals(spark, sf_dir)).withColumnRenamed("arrival_time", "sent_at").drop("arrival_ms")
    rows = arrival_timestamp(with_arrival(sent, "sent_at"))
    text = F.date_format("arrival_time", "yyyy-MM-dd HH:mm:ss").alias("arrival")
    return rows.select("event_id", text, (F.unix_millis("arrival_time") % 1000).alias("arrival_part"))


@query("split_bp", "defaulted", "SELECT event_id, sys AS systolic_bp, dia AS diastolic_bp FROM defaulted")
def _split_bp(spark, sf_dir):
    systolic, diastolic = V.split_bp(F.col("blood_pressure"))
    return vitals_with_unknown(spark, sf_dir).select("event_id", systolic.alias("systolic_bp"), diastolic.alias("diastolic_bp"))


@query("split_bp_reject", "bp", "SELECT event_id, sys0 AS systolic_bp, dia0 AS diastolic_bp FROM bp")
def _split_bp_reject(spark, sf_dir):
    systolic, diastolic = V.split_bp(F.col("blood_pressure"), "reject")
    return vitals(spark, sf_dir).select("event_id", systolic.alias("systolic_bp"), diastolic.alias("diastolic_bp"))


@query("validate_bp", "vitals", "SELECT event_id, regexp_full_match(blood_pressure, '[0-9.]+/[0-9.]+') AS valid FROM vitals")
def _validate_bp(spark, sf_dir):
    return vitals(spark, sf_dir).select("event_id", V.validate_bp(F.col("blood_pressure")).alias("valid"))


def _with_gaps(df):
    """Vitals in which some values of every kind are absent."""
    return df.withColumns(
        {
            "blood_pressure": F.nullif("blood_pressure", F.lit("n/a")),
            "bmi": F.nullif("bmi", F.lit(18.0).cast("double")),
            "age": F.nullif("age", F.lit(18)),
            "gender": F.nullif("gender", F.lit("Other")),
            "cholesterol": F.nullif("cholesterol", F.lit(150)),
            "medication_count": F.nullif("medication_count", F.lit(3)),
            "length_of_stay": F.nullif("length_of_stay", F.lit(7)),
            "diabetes": F.nullif("diabetes", F.lit("Yes")),
            "hypertension": F.nullif("hypertension", F.lit("Yes")),
            "discharge_destination": F.nullif("discharge_destination", F.lit("Rehab")),
        }
    )


@query(
    "validate_required",
    "vitals",
    """
SELECT error, count(*) AS n FROM (
  SELECT CASE WHEN patient_id IS NULL THEN 'Missing required field: patient_id' WHEN age = 18 THEN 'Missing required field: age'
    WHEN blood_pressure = 'n/a' THEN 'Missing required field: blood_pressure' WHEN bmi = 18 THEN 'Missing required field: bmi' END AS error
  FROM vitals) GROUP BY ALL""",
)
def _validate_required(spark, sf_dir):
    return validate_required(_with_gaps(vitals(spark, sf_dir))).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "missing_event_time",
    "vitals",
    "SELECT CASE WHEN event_id = 0 THEN 'missing_event_time' END AS error, count(*) AS n FROM vitals GROUP BY ALL",
)
def _missing_event_time(spark, sf_dir):
    rows = vitals(spark, sf_dir).withColumn("event_ms", F.when(F.col("event_id") != 0, F.col("event_ms")))
    return event_time_error(rows).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "encode",
    "vitals",
    """
SELECT event_id, CASE gender WHEN 'Male' THEN 0e0 WHEN 'Female' THEN 1e0 ELSE 2e0 END AS gender_code,
  CASE gender WHEN 'Male' THEN 0e0 WHEN 'Female' THEN 1e0 END AS gender_known,
  CASE discharge_destination WHEN 'Home' THEN 0e0 WHEN 'Nursing_Facility' THEN 1e0 WHEN 'Rehab' THEN 2e0 END AS destination_code,
  CASE diabetes WHEN 'Yes' THEN 1e0 ELSE 0e0 END AS diabetes_code
FROM vitals""",
)
def _encode(spark, sf_dir):
    known = {"Male": 0, "Female": 1}
    return vitals(spark, sf_dir).select(
        "event_id",
        V.encode(F.col("gender"), known, 2).alias("gender_code"),
        V.encode(F.col("gender"), known).alias("gender_known"),
        V.encode(F.col("discharge_destination"), V.DESTINATION_CODES).alias("destination_code"),
        V.encode(F.col("diabetes"), V.YES_NO_CODES, 0).alias("diabetes_code"),
    )


@query(
    "fill_defaults",
    "vitals",
    """
SELECT event_id, gender, CASE WHEN cholesterol = 150 THEN 200 ELSE cholesterol END AS cholesterol,
  CASE WHEN medication_count = 3 THEN 0 ELSE medication_count END AS medication_count,
  CASE WHEN length_of_stay = 7 THEN 3 ELSE length_of_stay END AS length_of_stay, 'No' AS diabetes, 'No' AS hypertension,
  CASE discharge_destination WHEN 'Rehab' THEN 'Home' ELSE discharge_destination END AS discharge_destination
FROM vitals""",
)
def _fill_defaults(spark, sf_dir):
    filled = fill_defaults(_with_gaps(vitals(spark, sf_dir)))
    return filled.select(
        "event_id", "gender", "cholesterol", "medication_count", "length_of_stay", "diabetes", "hypertension", "discharge_destination"
    )


@query("derive_hypertension", "scored", "SELECT event_id, CASE WHEN sys > 140 OR dia > 90 THEN 1 ELSE 0 END::bigint AS hypertension FROM scored")
def _derive_hypertension(spark, sf_dir):
    flag = V.derive_hypertension(*V.split_bp(F.col("blood_pressure"))).cast("bigint")
    return vitals(spark, sf_dir).select("event_id", flag.alias("hypertension"))


@query(
    "feature_array",
    "scored",
    """
SELECT event_id, unnest(range(0, 11)) AS position, round(unnest([age::double,
  CASE gender WHEN 'Male' THEN 0 WHEN 'Female' THEN 1 ELSE 2 END, sys, dia, cholesterol, bmi, dm, ht, medication_count, length_of_stay,
  CASE discharge_destination WHEN 'Nursing_Facility' THEN 1 WHEN 'Rehab' THEN 2 ELSE 0 END]), 3) AS feature
FROM scored""",
)
def _feature_array(spark, sf_dir):
    ready = featurize(vitals(spark, sf_dir))
    array = V.feature_array(F.col("features"), FEATURE_ORDER)
    rows = ready.select("event_id", F.posexplode(array).alias("position", "feature"))
    return rows.select("event_id", F.col("position").cast("bigint").alias("position"), F.round(F.col("feature").cast("double"), 3).alias("feature"))


@query(
    "risk_factor_score",
    "defaulted",
    """
SELECT event_id, round(z, 6) AS logit, round(1 / (1 + exp(-z)), 6) AS probability FROM (
  SELECT event_id, age * 1e-2 + sys * 5e-3 + dm * 3e-1 + ht * 2e-1 + medication_count * 5e-2 + CASE WHEN bmi > 30 THEN 15e-2 ELSE 0e0 END AS z
  FROM defaulted)""",
)
def _risk_factor_score(spark, sf_dir):
    f = F.col("features")
    z = scores.risk_factor_logit(f["age"], f["systolic_bp"], f["diabetes"], f["hypertension"], f["medication_count"], f["bmi"])
    rows = featurize(vitals_with_unknown(spark, sf_dir)).select("event_id", z.alias("logit"))
    return rows.select("event_id", r6("logit", "logit"), r6(scores.sigmoid(F.col("logit")), "probability"))


@query(
    "normalize_output",
    "defaulted",
    """
SELECT event_id, round(CASE source_partition WHEN 0 THEN risk WHEN 1 THEN 1 / (1 + exp(-(sys - 130) / 10))
  ELSE CASE WHEN bmi / 30 <= 1 THEN bmi / 30 ELSE 1 / (1 + exp(-bmi / 30)) END END, 6) AS probability
FROM defaulted""",
)
def _normalize_output(spark, sf_dir):
    scored = score_vitals(vitals_with_unknown(spark, sf_dir))
    risk, systolic, third = F.col("risk_score"), F.col("features.systolic_bp"), F.col("bmi") / 30
    out = (
        F.when(F.col("source_partition") == 0, F.array(1 - risk, risk))
        .when(F.col("source_partition") == 1, F.array((systolic - 130) / 10))
        .otherwise(F.array(third, risk, risk))
    )
    return scored.select("event_id", r6(scores.normalize_output(out), "probability"))


@query("anomaly_flag", "scored", "SELECT event_id, anomaly FROM scored")
def _anomaly_flag(spark, sf_dir):
    return score_vitals(vitals(spark, sf_dir)).select("event_id", "anomaly")


@query(
    "coerce_numeric",
    "vitals",
    """
SELECT event_id, TRY_CAST(split_part(blood_pressure, '/', 1) AS double) AS reading,
  CASE WHEN TRY_CAST(split_part(blood_pressure, '/', 1) AS double) IS NULL THEN 'reading is not a number: ''n''' END AS error
FROM vitals""",
)
def _coerce_numeric(spark, sf_dir):
    rows = vitals(spark, sf_dir).select("event_id", F.split("blood_pressure", "/")[0].alias("reading"))
    return coerce_numeric(rows, {"reading": "double"})


@query(
    "delay_ms",
    "vitals",
    """
SELECT event_id, arrival_ms - event_ms AS delay_ms, (arrival_ms - event_ms) / 1000e0 AS delay_s,
  arrival_ms - event_ms > 300000 AS is_late, strftime(make_timestamp_ms(event_ms), '%Y-%m-%d %H:%M:%S') AS event_time
FROM vitals""",
)
def _delay_ms(spark, sf_dir):
    delay = timing.delay_ms(F.col("arrival_ms"), F.col("event_ms"))
    return vitals(spark, sf_dir).select(
        "event_id",
        delay.alias("delay_ms"),
        timing.ms_to_seconds(delay).alias("delay_s"),
        timing.is_late(delay).alias("is_late"),
        F.date_format(timing.ms_to_ts(F.col("event_ms")), "yyyy-MM-dd HH:mm:ss").alias("event_time"),
    )


@query(
    "unit_scale",
    "",
    "SELECT event_id, value * 1000 AS ms, value / 1000 AS s, value * 1e6 / 1024 / 1024 AS mb FROM events",
)
def _unit_scale(spark, sf_dir):
    value = F.col("value")
    return events(spark, sf_dir).select(
        "event_id", timing.seconds_to_ms(value).alias("ms"), timing.ms_to_seconds(value).alias("s"), timing.bytes_to_mb(value * 1e6).alias("mb")
    )


@query(
    "score_display",
    "scored",
    """
SELECT event_id, concat('features:patient:', patient_id) AS feature_key, round(risk, 4) AS shown, anomaly::int::bigint AS anomaly_gauge,
  CASE WHEN risk >= 0.7 THEN 'red' WHEN risk >= 0.5 THEN 'yellow' ELSE 'green' END AS band
FROM scored""",
)
def _score_display(spark, sf_dir):
    risk = F.col("risk_score")
    return score_vitals(vitals(spark, sf_dir)).select(
        "event_id",
        records.feature_key(F.col("patient_id")).alias("feature_key"),
        scores.round_score(risk).alias("shown"),
        scores.bool_to_int(F.col("anomaly")).alias("anomaly_gauge"),
        scores.severity_band(risk, scores.RISK_BANDS).alias("band"),
    )


@query(
    "json_record",
    "scored",
    "SELECT patient_id, event_ms, anomaly, blood_pressure, round(risk, 6) AS risk_score FROM scored",
)
def _json_record(spark, sf_dir):
    record = score_vitals(vitals(spark, sf_dir)).select("patient_id", "event_ms", "anomaly", "blood_pressure", "risk_score")
    back = records.as_json(record).select(F.from_json("value", record.schema).alias("r")).select("r.*")
    return back.withColumn("risk_score", F.round("risk_score", 6))


@query(
    "project_vitals",
    "vitals",
    "SELECT event_id, event_ms, patient_id, age, glucose_level, blood_pressure, bmi, 0e0 AS readmission_risk FROM vitals",
)
def _project_vitals(spark, sf_dir):
    return records.project_vitals(vitals(spark, sf_dir))


@query(
    "project_prediction",
    "judged",
    """
SELECT patient_id, round(risk, 4) AS risk_score, anomaly, age, glucose_level, blood_pressure, bmi,
  arrival_ms - event_ms AS e2e_latency_ms, event_ms AS timestamp, arrival_ms AS processing_timestamp
FROM judged WHERE error IS NULL""",
)
def _project_prediction(spark, sf_dir):
    full = records.project_prediction(successful_only(score_request(vitals(spark, sf_dir))))
    return full.drop("inference_ms", "feature_ms", "processing_ms")


@query(
    "project_prediction_short",
    "judged",
    """
SELECT patient_id, round(risk, 6) AS risk_score, anomaly, arrival_ms AS processing_timestamp, event_ms AS event_timestamp
FROM judged WHERE error IS NULL""",
)
def _project_prediction_short(spark, sf_dir):
    short = records.project_prediction(successful_only(score_request(vitals(spark, sf_dir))), full=False)
    return short.withColumn("risk_score", F.round("risk_score", 6))


_TRAINING_SQL = """
SELECT event_id, age::double AS age, CASE gender WHEN 'Male' THEN 0e0 WHEN 'Female' THEN 1e0 ELSE 2e0 END AS gender,
  sys0 AS systolic_bp, dia0 AS diastolic_bp, cholesterol::double AS cholesterol, bmi, dm::double AS diabetes, ht::double AS hypertension,
  medication_count::double AS medication_count, length_of_stay::double AS length_of_stay,
  CASE discharge_destination WHEN 'Nursing_Facility' THEN 1e0 WHEN 'Rehab' THEN 2e0 ELSE 0e0 END AS discharge_destination,
  CASE readmitted_30_days WHEN 'Yes' THEN 1 ELSE 0 END AS readmitted_30_days
FROM bp"""


@query("prepare_training", "bp", _TRAINING_SQL)
def _prepare_training(spark, sf_dir):
    return prepare_training(vitals(spark, sf_dir), ["event_id"])


@query("label_rate", "vitals", "SELECT round(avg((readmitted_30_days = 'Yes')::int), 6) AS label_rate FROM vitals")
def _label_rate(spark, sf_dir):
    return label_rate(prepare_training(vitals(spark, sf_dir))).select(r6("label_rate", "label_rate"))


@query("score_vitals", "scored", "SELECT event_id, round(risk, 6) AS risk_score, anomaly, error FROM scored")
def _score_vitals(spark, sf_dir):
    return score_vitals(vitals(spark, sf_dir)).select("event_id", r6("risk_score", "risk_score"), "anomaly", "error")


@query("score_vitals_default_bp", "defaulted", "SELECT event_id, round(risk, 6) AS risk_score, anomaly, NULL::varchar AS error FROM defaulted")
def _score_vitals_default_bp(spark, sf_dir):
    return score_vitals(vitals_with_unknown(spark, sf_dir)).select("event_id", r6("risk_score", "risk_score"), "anomaly", "error")


@query(
    "score_vitals_only",
    "scored",
    """
SELECT event_id, round(r, 6) AS risk_score, error IS NULL AND (r > 0.7 OR sys > 160 OR dia > 100 OR bmi > 35) AS anomaly FROM (
  SELECT *, CASE WHEN error IS NOT NULL THEN 0 ELSE 1 / (1 + exp(-(-1.5 + 0.01 * age + 0.005 * sys + CASE WHEN sys > 140 OR dia > 90 THEN 0.2 ELSE 0 END
    + CASE WHEN bmi > 30 THEN 0.15 ELSE 0 END))) END AS r FROM scored)""",
)
def _score_vitals_only(spark, sf_dir):
    return score_vitals(vitals(spark, sf_dir), policy="vitals_only").select("event_id", r6("risk_score", "risk_score"), "anomaly")


@query(
    "sql_scoring",
    "scored",
    """
SELECT patient_id, event_ms, CASE WHEN error IS NULL THEN round(r, 4) END AS risk_score,
  CASE WHEN error IS NULL THEN r > 0.7 OR sys > 160 OR dia > 100 OR bmi > 35 END AS anomaly, error IS NOT NULL AS failed FROM (
  SELECT *, 1 / (1 + exp(-(-15e-1 + 1e-2 * age + 5e-3 * sys + 2e-1 * (sys > 140 OR dia > 90)::int + 15e-2 * (bmi > 30)::int))) AS r FROM scored)""",
)
def _sql_scoring(spark, sf_dir):
    """The scorer called from SQL, its JSON read back."""
    register_scoring_functions(spark)
    text = spark.sql(
        "SELECT predict_patient_risk_json(patient_id, age, glucose_level, blood_pressure, bmi, event_ms) AS value FROM {rows}",
        rows=vitals(spark, sf_dir),
    )
    record = "patient_id STRING, risk_score DOUBLE, anomaly BOOLEAN, error STRING, timestamp BIGINT"
    return text.select(F.from_json("value", record).alias("r")).select(
        "r.patient_id", F.col("r.timestamp").alias("event_ms"), "r.risk_score", "r.anomaly", F.col("r.error").isNotNull().alias("failed")
    )


@query(
    "score_request",
    "judged",
    """
SELECT event_id, round(risk, 6) AS risk_score, anomaly, error, CASE WHEN error IS NULL THEN '1.0' END AS model_version FROM judged""",
)
def _score_request(spark, sf_dir):
    return score_request(vitals_with_unknown(spark, sf_dir, everywhere=False)).select("event_id", r6("risk_score", "risk_score"), "anomaly", "error", "model_version")


@query(
    "score_with_model",
    "scored",
    """
SELECT event_id, model_version, round(CASE WHEN error IS NOT NULL THEN 0 WHEN model_version = '1.0' THEN risk WHEN model_version = '1.1' THEN 1 / (1 + exp(-(0.5 - 0.01 * age + 0.02 * (bmi - 25)))) ELSE 0 END, 6) AS risk_score,
  coalesce(error, CASE model_version WHEN '1.2' THEN 'Unknown model version: 1.2' END) AS error
FROM (SELECT *, CASE discharge_destination WHEN 'Home' THEN '1.0' WHEN 'Rehab' THEN '1.1' ELSE '1.2' END AS model_version FROM scored)""",
)
def _score_with_model(spark, sf_dir):
    other = RiskModel({"age": -0.01, "bmi": 0.02}, 0.0, version="1.1")
    version = F.when(F.col("discharge_destination") == "Home", "1.0").when(F.col("discharge_destination") == "Rehab", "1.1").otherwise("1.2")
    scored = score_with_model(vitals(spark, sf_dir).withColumn("model_version", version), model_table(spark, [RISK_FACTOR_MODEL, other]))
    return scored.select("event_id", "model_version", r6("risk_score", "risk_score"), "error")


@query(
    "successful_only",
    "judged",
    "SELECT patient_id, count(*) AS n, round(avg(risk), 6) AS mean_risk FROM judged WHERE error IS NULL GROUP BY ALL",
)
def _successful_only(spark, sf_dir):
    good = successful_only(score_request(vitals(spark, sf_dir)))
    return good.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("risk_score"), "mean_risk"))


@query(
    "dead_letter",
    "judged",
    "SELECT event_id, patient_id, CASE source_partition % 2 WHEN 0 THEN 'unknown' ELSE 'n/a' END AS blood_pressure, error, event_ms AS timestamp FROM judged WHERE error IS NOT NULL",
)
def _dead_letter(spark, sf_dir):
    letters = dead_letter(score_request(vitals_with_unknown(spark, sf_dir, everywhere=False)))
    return letters.select("original_data.event_id", "original_data.patient_id", "original_data.blood_pressure", "error", "timestamp")


@query("dead_letter_inline", "judged", "SELECT patient_id, error, event_ms AS timestamp FROM judged WHERE error IS NOT NULL")
def _dead_letter_inline(spark, sf_dir):
    return dead_letter(score_request(vitals_with_unknown(spark, sf_dir, everywhere=False)), inline=True)

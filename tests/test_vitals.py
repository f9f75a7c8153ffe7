"""Hand rows with known answers for functions over single events."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardwatch.functions import records, scores, timing
from wardwatch.functions import vitals as V
from wardwatch.operators.features import coerce_numeric, featurize
from wardwatch.operators.scoring import RISK_FACTOR_MODEL, dead_letter, model_info, score_request, score_vitals
from wardwatch.schemas import FEATURE_ORDER
from wardwatch.sources.vitals import event_time_error, parse_vitals, vitals_table, with_arrival


def one(spark, **columns):
    return spark.range(1).select(*[(c if not isinstance(c, (str, int, float, bool, type(None))) else F.lit(c)).alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    ("text", "policy", "parts", "error"),
    [
        ("130/72", "default", (130.0, 72.0), None),
        ("130/72", "reject", (130.0, 72.0), None),
        ("unknown", "default", (120.0, 80.0), None),
        ("unknown", "reject", (None, None), V.BP_FORMAT_ERROR),
        ("120/80/1", "default", (120.0, 80.0), None),
        ("120/80/1", "reject", (None, None), V.BP_FORMAT_ERROR),
        ("abc/80", "default", (None, 80.0), "could not convert string to float: 'abc'"),
        ("abc/80", "reject", (None, 80.0), "could not convert string to float: 'abc'"),
        ("n/a", "default", (None, None), "could not convert string to float: 'n'"),
        (None, "default", (None, None), None),
    ],
)
def test_split_bp(spark, text, policy, parts, error):
    bp = F.lit(text).cast("string")
    systolic, diastolic = V.split_bp(bp, policy)
    row = one(spark, s=systolic, d=diastolic, e=V.bp_error(bp, policy), v=V.validate_bp(bp))
    assert (row.s, row.d) == parts
    assert row.e == error
    assert row.v is (text == "130/72")


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 300), st.integers(1, 300))
def test_split_bp_round_trip(spark, s, d):
    systolic, diastolic = V.split_bp(F.lit(f"{s}/{d}"))
    row = one(spark, s=systolic, d=diastolic)
    assert (row.s, row.d) == (s, d)


@pytest.mark.parametrize(
    ("risk", "s", "d", "bmi", "flag"),
    [
        (0.7, 160, 100, 35.0, False),
        (0.7001, 100, 60, 20.0, True),
        (0.1, 161, 60, 20.0, True),
        (0.1, 100, 101, 20.0, True),
        (0.1, 100, 60, 35.1, True),
        (0.1, None, None, None, False),
        (0.9, None, None, None, True),
    ],
)
def test_anomaly_limits_are_strict(spark, risk, s, d, bmi, flag):
    columns = [F.lit(x).cast("double") for x in (risk, s, d, bmi)]
    assert one(spark, a=scores.anomaly_flag(*columns)).a is flag


def test_lateness_limit_is_strict(spark):
    row = one(spark, a=timing.is_late(F.lit(300_000)), b=timing.is_late(F.lit(300_001)), c=timing.is_late(F.lit(None).cast("bigint")))
    assert (row.a, row.b, row.c) == (False, True, False)


def test_codes_of_unknown_categories(spark):
    gender = F.lit("X")
    row = one(spark, scoring=V.encode(gender, V.GENDER_CODES, 2), training=V.encode(gender, V.GENDER_CODES))
    assert (row.scoring, row.training) == (2.0, None)


@pytest.mark.parametrize(
    ("out", "p"), [([0.3, 0.7], 0.7), ([0.0], 0.5), ([0.4, 0.3, 0.3], 0.4), ([1.0, 0.0, 0.0], 1.0), ([2.0, 0.0, 0.0], 0.8807970779778823)]
)
def test_normalize_output(spark, out, p):
    assert one(spark, p=scores.normalize_output(F.array(*[F.lit(x) for x in out]))).p == pytest.approx(p)


@pytest.mark.parametrize(("x", "band"), [(0.09, "green"), (0.1, "yellow"), (0.19, "yellow"), (0.2, "red"), (3.0, "red")])
def test_severity_bands(spark, x, band):
    assert one(spark, b=scores.severity_band(F.lit(x), scores.DRIFT_BANDS)).b == band


def test_hypertension_from_either_reading(spark):
    got = [one(spark, h=V.derive_hypertension(F.lit(s), F.lit(d))).h for s, d in ((140, 90), (141, 60), (100, 91))]
    assert got == [0, 1, 1]


def test_cells(spark):
    row = one(spark, a=timing.cell_start(F.lit(120_000), 60_000), b=timing.cell_end(F.lit(120_000), 60_000), c=timing.cell_end(F.lit(120_001), 60_000))
    assert (row.a, row.b, row.c) == (120_000, 120_000, 180_000)


BAD_AND_GOOD = [
    '{"bmi":24.5,"ward":"B7"}',
    '{"patient_id":"x-41","age":{"years":50},"gender":"Male"}',
    "{patient_id: 7",
    "[]",
    '"text"',
    '{"patient_id":1,"age":50,"blood_pressure":"130/72","bmi":31.5,"timestamp":1700000000000}',
    '{"patient_id":"2","age":50,"blood_pressure":"130/72","bmi":31.5,"ts":1700000000001,"timestamp":5}',
    '{"patient_id":3,"age":50,"blood_pressure":"130/72","bmi":31.5}',
]


def test_json_with_bad_rows(spark):
    raw = spark.createDataFrame([(t,) for t in BAD_AND_GOOD], "value STRING")
    scored = score_request(event_time_error(with_arrival(parse_vitals(raw))))
    rows = {(r.patient_id, r.event_ms): r.error for r in scored.collect()}
    assert rows == {
        (None, None): "missing_event_time",
        ("x-41", None): "missing_event_time",
        ("1", 1700000000000): None,
        ("2", 1700000000001): None,
        ("3", None): "missing_event_time",
    }


def test_wrong_type_is_null_and_reported_as_missing(spark):
    raw = spark.createDataFrame([(t,) for t in BAD_AND_GOOD[:3]], "value STRING")
    errors = {r.patient_id: r.error for r in score_request(parse_vitals(raw)).collect()}
    assert errors == {None: "Missing required field: patient_id", "x-41": "Missing required field: age"}


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("50",), ("invalid",), (None,)], "age STRING")
    got = [(r.age, r.error) for r in coerce_numeric(df, {"age": "double"}).collect()]
    assert got == [(50.0, None), (None, "age is not a number: 'invalid'"), (None, None)]


def event(spark, **over):
    fields = {"patient_id": "1", "age": 60, "blood_pressure": "150/95", "bmi": 31.0, "event_ms": 1000, "arrival_ms": 1500, "glucose_level": 99.0, **over}
    types = {"patient_id": "string", "blood_pressure": "string", "bmi": "double", "glucose_level": "double"}
    return spark.range(1).select(*[F.lit(v).cast(types.get(k, "bigint")).alias(k) for k, v in fields.items()])


def test_missing_field_names_the_first(spark):
    assert score_vitals(event(spark, bmi=None)).first().error == "Missing required field: bmi"
    assert score_vitals(event(spark, bmi=None, age=None)).first().error == "Missing required field: age"
    assert score_vitals(event(spark, blood_pressure=None)).first().error == "Missing required field: blood_pressure"


def test_policies_differ_in_hypertension(spark):
    service = featurize(event(spark), "service").first().features
    vitals_only = featurize(event(spark), "vitals_only").first().features
    assert (service.hypertension, vitals_only.hypertension) == (0.0, 1.0)
    assert (service.gender, vitals_only.gender) == (2.0, 0.0)
    assert (service.cholesterol, service.length_of_stay) == (200.0, 3.0)
    assert service.__fields__ == list(FEATURE_ORDER)


def test_error_row_scores_zero_and_goes_to_dead_letters(spark):
    scored = score_request(event(spark, blood_pressure="high", bmi=50.0))
    row = scored.first()
    assert (row.risk_score, row.anomaly, row.model_version, row.error) == (0.0, False, None, V.BP_FORMAT_ERROR)
    letter = dead_letter(scored).first()
    assert letter.original_data.blood_pressure == "high" and letter.timestamp == 1000
    assert not set(letter.original_data.__fields__) & {"features", "risk_score", "error"}
    assert dead_letter(scored, inline=True).columns == ["patient_id", "error", "timestamp"]


def test_scores_stay_inside_zero_and_one(spark):
    rows = score_vitals(event(spark, age=10_000)).unionByName(score_vitals(event(spark, age=-10_000))).collect()
    assert all(0.0 <= r.risk_score <= 1.0 for r in rows)


def test_prediction_record_has_thirteen_fields(spark):
    row = records.as_json(records.project_prediction(score_vitals(event(spark)))).first().value
    got = json.loads(row)
    assert got["e2e_latency_ms"] == 500 and got["timestamp"] == 1000
    assert len(records.project_prediction(score_vitals(event(spark))).columns) == 13
    assert len(records.project_prediction(score_vitals(event(spark)), full=False).columns) == 5


def test_scoring_runs_without_python_and_reads_needed_columns_only(spark, sf_dir):
    from wardwatch.fixtures import vitals

    plan = score_vitals(vitals(spark, sf_dir)).select("event_id", "risk_score")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_csv_table(spark, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text(
        "patient_id,age,gender,blood_pressure,cholesterol,bmi,diabetes,hypertension,medication_count,length_of_stay,discharge_destination,readmitted_30_days\n"
        "7,74,Other,130/72,240,31.5,Yes,No,5,1,Nursing_Facility,Yes\n"
    )
    row = vitals_table(spark, str(path)).first()
    assert (row.patient_id, row.bmi, row.readmitted_30_days) == (7, 31.5, "Yes")


def test_model_info(spark):
    info = model_info(spark, RISK_FACTOR_MODEL).first()
    assert info.n_features == len(info.feature_columns) and info.version == "1.0"

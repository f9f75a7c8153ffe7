"""Per-patient history on hand rows, and the plans behind it."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardwatch.operators import history as H
from wardwatch.operators import reconcile as C


def scored(spark, rows):
    """Rows `(patient, id, ms, glucose, systolic, ok)`."""
    df = spark.createDataFrame(rows, "patient_id STRING, event_id BIGINT, event_ms BIGINT, glucose_level DOUBLE, s DOUBLE, ok BOOLEAN")
    return df.select(
        "patient_id",
        "event_id",
        "event_ms",
        "glucose_level",
        F.struct(F.col("s").alias("systolic_bp"), (F.col("s") - 40).alias("diastolic_bp")).alias("features"),
        F.when(F.col("ok"), F.col("glucose_level") / 200).otherwise(0.0).alias("risk_score"),
        F.lit(False).alias("anomaly"),
        F.when(~F.col("ok"), F.lit("bad")).alias("error"),
    )


@pytest.mark.parametrize("chunk", [10**9, 2])
def test_error_between_two_good_rows(spark, chunk):
    df = scored(spark, [("a", 1, 0, 100.0, 120.0, True), ("a", 2, 1000, 500.0, 200.0, False), ("a", 3, 2000, 110.0, 125.0, True)])
    rows = H.vitals_delta(df, rows_per_chunk=chunk).orderBy("event_id").collect()
    assert rows[0].glucose_change is None and rows[0].previous_readmission_risk is None
    assert rows[1].glucose_change == 400.0
    assert (rows[2].glucose_change, rows[2].bp_change, rows[2].previous_ms, rows[2].previous_readmission_risk) == (10.0, 5.0, 0, 0.5)


def test_reading_expires(spark):
    df = scored(spark, [("a", 1, 0, 100.0, 120.0, True), ("a", 2, H.HOUR_MS, 110.0, 120.0, True), ("a", 3, 2 * H.HOUR_MS + 1, 120.0, 120.0, True)])
    rows = H.vitals_delta(df).orderBy("event_id").collect()
    assert rows[1].glucose_change == 10.0 and rows[2].glucose_change is None


def test_absent_field_of_the_previous_reading_counts_zero(spark):
    df = scored(spark, [("a", 1, 0, None, 120.0, True), ("a", 2, 10, 90.0, 120.0, True)])
    assert H.vitals_delta(df).orderBy("event_id").collect()[1].glucose_change == 90.0


def test_as_of_lookup_is_strictly_earlier(spark):
    events = spark.createDataFrame([("a", 1, 100), ("a", 2, 100), ("a", 3, 100 + H.DAY_MS), ("b", 4, 5)], "patient_id STRING, event_id BIGINT, event_ms BIGINT")
    facts = spark.createDataFrame([("a", 1, 100, 0.9, True)], "patient_id STRING, event_id BIGINT, event_ms BIGINT, risk_score DOUBLE, anomaly BOOLEAN")
    for chunk in (10**9, 2):
        got = {r.event_id: (r.previous_risk_score, r.previous_anomaly) for r in H.enrich_latest(events, facts, rows_per_chunk=chunk).collect()}
        assert got == {1: (0.0, False), 2: (0.9, True), 3: (0.0, False), 4: (0.0, False)}


def test_history_keeps_the_newest(spark):
    rows = [("a", i, i // 2, 0.5, False) for i in range(30)]
    df = spark.createDataFrame(rows, "patient_id STRING, event_id BIGINT, event_ms BIGINT, risk_score DOUBLE, anomaly BOOLEAN")
    got = [r.event_id for r in H.recent_history(df, 5).orderBy("position").collect()]
    assert got == [29, 28, 27, 26, 25]


def test_history_is_limited_before_the_shuffle(spark, sf_dir):
    from wardwatch.fixtures import vitals

    plan = H.recent_history(vitals(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_upsert_expires_and_replaces(spark):
    schema = "patient_id STRING, risk_score DOUBLE, anomaly BOOLEAN, event_ms BIGINT, event_id BIGINT"
    old = spark.createDataFrame([("a", 0.1, False, 0, 1), ("b", 0.2, False, 50, 2)], schema)
    new = spark.createDataFrame([("b", 0.3, True, 60, 3), ("b", 0.4, True, 55, 4)], schema)
    got = {r.patient_id: r.risk_score for r in H.upsert_features(old, new, 110, ttl_ms=100).collect()}
    assert got == {"b": 0.3}


def test_reconcile_counts_missing_and_repeated(spark):
    sent = spark.createDataFrame([(i,) for i in range(10)], "event_id BIGINT")
    got = spark.createDataFrame([(i,) for i in range(8)] + [(0,), (0,)], "event_id BIGINT")
    row = C.reconcile(sent, got).first()
    assert (row.sent, row.processed, row.missing, row.duplicates, row.success_rate, row.all_processed) == (10, 8, 2, 2, 0.8, False)
    assert sorted(r.event_id for r in C.missing_keys(sent, got).collect()) == [8, 9]


def test_reconcile_of_nothing(spark):
    empty = spark.createDataFrame([], "event_id BIGINT")
    row = C.reconcile(empty, empty).first()
    assert (row.sent, row.missing, row.success_rate) == (0, 0, 0.0)


def test_reconcile_by_checksum_equals_reconcile(spark):
    """Keys missing, repeated on either side, never sent, null; and sides that agree or are empty."""
    schema = "event_id BIGINT, note STRING"
    sent = spark.createDataFrame([(i % 500, "a") for i in range(900)] + [(None, "n")] * 3, schema)
    got = spark.createDataFrame([(i % 490, "b") for i in range(1_000)] + [(i, "c") for i in range(600, 607)] + [(None, "n")], schema)
    empty = sent.limit(0)
    for a, b in ((sent, got), (sent.where("event_id > 3"), sent.where("event_id > 3")), (empty, got), (empty, empty)):
        want, row = C.reconcile(a, b).first(), C.reconcile_by_checksum(a, b).first()
        assert (row.missing, row.duplicates, row.all_processed) == (want.missing, want.duplicates, want.all_processed)
        assert (row.sent_rows, row.received_rows) == (a.count(), b.count())
        assert row.unexpected == C.reconcile(b, a).first().missing
        counts = lambda df: df.where("event_id IS NOT NULL").groupBy("event_id").count().toPandas().set_index("event_id")["count"]
        both = pd.DataFrame({"s": counts(a), "r": counts(b)}).fillna(0).astype(int)
        differ = both[both.s != both.r]
        found = {r.event_id: (r.sent, r.received) for r in C.differing_keys(a, b).collect()}
        assert found == {k: (r.s, r.r) for k, r in differ.iterrows()}


def test_checksums_open_few_rows(spark):
    sent = spark.range(300_000).withColumnRenamed("id", "event_id")
    got = sent.where("event_id % 30000 <> 17")
    rows = C._tagged(sent, got, "event_id")
    for levels, share in ((1, 0.01), (2, 0.0001)):
        opened = C._open_rows(rows, levels)[0].count()
        assert 10 <= opened < share * rows.count()
    assert C.reconcile_by_checksum(sent, got).first().missing == 10
    # Two keys exchanged for two others of the same number are seen too.
    moved = got.unionByName(spark.range(400_000, 400_010).withColumnRenamed("id", "event_id"))
    row = C.reconcile_by_checksum(sent, moved).first()
    assert (row.sent_rows, row.received_rows, row.missing, row.unexpected) == (300_000, 300_000, 10, 10)


def test_metric_or_takes_the_second_only_where_the_first_is_absent(spark):
    a = spark.createDataFrame([(1, 5.0)], "t BIGINT, value DOUBLE")
    b = spark.createDataFrame([(1, 7.0), (2, 8.0)], "t BIGINT, value DOUBLE")
    assert sorted(tuple(r) for r in C.metric_or(a, b, ["t"]).collect()) == [(1, 5.0), (2, 8.0)]


def test_busy_patient_split_equals_plain(spark):
    rows = [("busy" if i % 3 == 0 else f"p{i % 7}", i, (i * 37) % 1000, float(i % 50), 100.0 + i % 60, i % 5 != 0) for i in range(600)]
    df = scored(spark, rows)
    columns = ["event_id", "previous_ms", "glucose_change", "bp_change", "previous_readmission_risk"]
    plain = H.vitals_delta(df).select(*columns).toPandas().sort_values("event_id", ignore_index=True)
    split = H.vitals_delta(df, rows_per_chunk=20).select(*columns).toPandas().sort_values("event_id", ignore_index=True)
    pd.testing.assert_frame_equal(plain, split)

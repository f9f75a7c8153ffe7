"""Request metrics, counters and alert states on hand rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardwatch.operators import alerts as A
from wardwatch.operators import requests as R
from wardwatch.plans import alerting as P
from wardwatch.sinks.tables import as_metrics, emit_metrics, read_metrics, write_predictions, write_report

REQUEST = "event_id BIGINT, ms BIGINT, source STRING, latency_ms DOUBLE, status STRING"


def test_stored_sketches_answer_any_range(spark):
    """A hot source, a small one, one of equal values, nulls and NaNs; ranks against the exact ones."""
    rng = np.random.default_rng(4)
    rows = [(i, i * 60, "hot" if i % 3 else "cool", float(v), "success") for i, v in enumerate(rng.lognormal(3, 1, 20_000))]
    rows += [(i, i * 3_000, "flat", 5.0, "success") for i in range(300)]
    rows += [(i, 0, "none", v, s) for i, (v, s) in enumerate([(None, "success"), (float("nan"), "success"), (1.0, "error")])]
    df = spark.createDataFrame(rows, REQUEST)
    stored = R.latency_sketches(df)
    assert stored.count() == stored.select("step_ms", "source").distinct().count() > 30
    for low, high in ((None, None), (120_000, 600_000)):
        got = {r.source: r for r in R.latency_between(stored, from_ms=low, to_ms=high).collect()}
        assert set(got) == {"hot", "cool", "flat"}
        for source, row in got.items():
            values = np.sort([r[3] for r in rows if r[2] == source and (low is None or low <= r[1] < high)])
            assert (row.n, row.lowest, row.highest) == (len(values), values[0], values[-1])
            for name, q in R.PERCENTILE_POINTS.items():
                below, upto = np.searchsorted(values, row[name], "left") / len(values), np.searchsorted(values, row[name], "right") / len(values)
                assert below <= q + 0.01 and upto >= q - 0.01
    assert R.latency_between(stored, by=()).first().n == 20_300
    assert R.latency_between(stored, from_ms=10**12).collect() == R.latency_between(stored, by=(), from_ms=10**12).collect() == []


def test_summary_of_nothing_is_zero(spark):
    row = R.latency_summary(spark.createDataFrame([], REQUEST)).first()
    assert (row.p99_ms, row.avg_latency_ms, row.error_rate, row.total_requests) == (0.0, 0.0, 0.0, 0)


def test_summary_counts_latencies_of_successes_only(spark):
    rows = [(i, i, "a", float(i), "success") for i in range(1, 101)] + [(0, 0, "a", 9e9, "timeout")]
    row = R.latency_summary(spark.createDataFrame(rows, REQUEST), digits=2).first()
    values = np.arange(1, 101)
    assert (row.p50_ms, row.p95_ms, row.p99_ms) == tuple(round(float(np.percentile(values, q)), 2) for q in (50, 95, 99))
    assert (row.max_latency_ms, row.error_count, row.error_rate, row.successful_requests) == (100.0, 1, 0.0099, 100)


@pytest.mark.parametrize(("p99", "passed"), [(29.99, True), (30.0, False)])
def test_target_is_strict(spark, p99, passed):
    assert R.slo_check(spark.range(1).select(F.lit(p99).alias("p99_ms"))).first().passed is passed


def test_histogram_quantile_by_hand(spark):
    rows = [("a", 10.0, 50.0), ("a", 20.0, 90.0), ("a", None, 100.0), ("none", 10.0, 0.0), ("none", None, 0.0)]
    df = spark.createDataFrame(rows, "s STRING, le DOUBLE, cum DOUBLE")
    got = R.histogram_quantiles(df, ["s"], {"p50": 0.5, "p70": 0.7, "p99": 0.99}).collect()
    assert [(r.s, r.p50, r.p70, r.p99) for r in got] == [("a", 10.0, 15.0, 20.0)]


@pytest.mark.parametrize("chunk", [10**9, 3])
def test_counter_reset(spark, chunk):
    rows = [("a", 0, 10.0), ("a", 60_000, 40.0), ("a", 120_000, 5.0), ("a", 360_000, 6.0), ("a", 361_000, 6.0)]
    df = spark.createDataFrame(rows, "source STRING, ms BIGINT, value DOUBLE")
    got = [r.rate * 300 for r in R.counter_rate(df, ["source"], rows_per_chunk=chunk).orderBy("ms").collect()]
    assert got == pytest.approx([0, 30, 35, 6, 6])


def test_counter_rate_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"source": "a", "ms": np.sort(rng.choice(4_000_000, 400, replace=False)), "value": (np.arange(400) * 3 % 170).astype(float)})
    got = R.counter_rate(spark.createDataFrame(pdf), ["source"], rows_per_chunk=40).orderBy("ms").toPandas()
    step = pdf.value.diff()
    gain = np.where(step >= 0, step, pdf.value)
    gain[0] = 0
    want = [gain[(pdf.ms > t - 300_000) & (pdf.ms <= t)].sum() / 300 for t in pdf.ms]
    assert np.allclose(got.rate, want)


def test_rolling_percentiles_match_brute_force(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"event_id": range(2600), "ms": range(2600), "source": "a", "latency_ms": rng.exponential(20, 2600)})
    got = R.rolling_percentiles(spark.createDataFrame(pdf), ["source"], every=700, rows_per_chunk=300).orderBy("report").toPandas()
    for r in got.itertuples():
        end = min(r.report * 700, 2600)
        part = pdf.latency_ms[max(0, end - 1000) : end]
        assert np.allclose([r.p50_ms, r.p99_ms, r.avg_latency_ms], [np.percentile(part, 50), np.percentile(part, 99), part.mean()])
    assert list(got.report) == [1, 2, 3, 4]


def test_short_series_are_reported_too(spark):
    df = spark.createDataFrame([("a", i, i, float(i)) for i in range(1, 41)], "source STRING, event_id INT, ms INT, latency_ms DOUBLE")
    got = R.rolling_percentiles(df, ["source"], every=500).collect()
    assert [(r.report, r.p50_ms) for r in got] == [(1, 20.5)]


def test_alert_states(spark):
    values = [0, 1, 1, 1, 0, None, 1, 1]
    df = spark.createDataFrame([(i * 60_000, None if v is None else float(v)) for i, v in enumerate(values)], "t_ms BIGINT, value DOUBLE")
    want = ["inactive", "pending", "pending", "firing", "inactive", "inactive", "pending", "pending"]
    for chunk in (10**9, 2):
        out = A.alert_hold(df, [], F.col("value") > 0, 120_000, rows_per_chunk=chunk).orderBy("t_ms").collect()
        assert [r.state for r in out] == want
        assert [r.active_since_ms for r in out] == [None, 60_000, 60_000, 60_000, None, None, 360_000, 360_000]


def test_a_hole_starts_anew(spark):
    """Two true samples ten hours apart are no ten hours of alert."""
    at = [0, 60_000, 36_000_000, 36_300_000, 36_600_001]
    df = spark.createDataFrame([(t, 1.0) for t in at], "t_ms BIGINT, value DOUBLE")
    for chunk in (10**9, 2):
        out = A.alert_hold(df, [], F.col("value") > 0, 300_000, rows_per_chunk=chunk).orderBy("t_ms").collect()
        assert [r.state for r in out] == ["pending", "pending", "pending", "firing", "pending"]
        assert [r.active_since_ms for r in out] == [0, 0, 36_000_000, 36_000_000, 36_600_001]


def test_rule_limits_and_texts(spark):
    df = spark.createDataFrame([(0, 0.1), (300_000, 0.1001), (600_000, 0.25)], "t_ms BIGINT, value DOUBLE")
    out = A.evaluate_rule(df, A.HIGH_LATE_RATIO).orderBy("t_ms").collect()
    assert [r.state for r in out] == ["inactive", "pending", "firing"]
    assert (out[2].description, out[0].description, out[2].severity) == ("Share of late data: 25.00%", None, "warning")


def test_missing_heartbeats_fire(spark):
    df = spark.createDataFrame([("m", 0), ("m", 59_999), ("m", 240_000)], "service STRING, arrival_ms BIGINT")
    out = P.model_server_down(df, ["service"]).orderBy("t_ms").collect()
    assert [r.state for r in out] == ["inactive", "pending", "firing", "firing", "inactive"]


def test_a_service_that_stops_for_good_is_down(spark):
    beats = [("a", i * 60_000) for i in range(10)] + [("b", i * 60_000) for i in range(3)] + [("c", 240_000)]
    df = spark.createDataFrame(beats, "service STRING, arrival_ms BIGINT")
    states = {}
    for r in P.model_server_down(df, ["service"], until_ms=660_000).orderBy("t_ms").collect():
        states.setdefault(r.service, []).append(r.state)
    assert states["a"] == ["inactive"] * 10 + ["pending", "firing"]
    assert states["b"] == ["inactive"] * 3 + ["pending"] + ["firing"] * 8
    assert states["c"] == ["inactive", "pending"] + ["firing"] * 6
    assert P.model_server_down(df.limit(0), ["service"]).collect() == []


def test_a_lone_dead_service_fires(spark):
    """Silent since minute 2; the receiver's clock, which other rows move, says how long. A wrong stamp costs one row."""
    df = spark.createDataFrame([("m", 0), ("m", 60_000), ("m", 120_000)], "service STRING, arrival_ms BIGINT")
    clock = spark.createDataFrame([(600_000,)], "arrival_ms BIGINT")
    (alert,) = P.down_alerts(P.service_intervals(df, ["service"], clock=clock), ["service"]).collect()
    assert (alert.since_ms, alert.firing_ms, alert.resolved_ms) == (180_000, 210_000, None)
    assert [r.state for r in P.model_server_down(df, ["service"], clock=clock).orderBy("t_ms").collect()] == ["inactive"] * 3 + ["pending"] + ["firing"] * 7
    far = df.unionByName(spark.createDataFrame([("x", 10**15)], df.schema))
    assert P.service_intervals(far, ["service"]).count() == 3
    assert {r.service for r in P.service_intervals(far, ["service"], clock=clock).collect()} == {"m"}
    back = df.unionByName(spark.createDataFrame([("m", 600_000)], df.schema))
    (alert,) = P.down_alerts(P.service_intervals(back, ["service"], clock=clock), ["service"]).collect()
    assert alert.resolved_ms == 600_000
    assert "NestedLoop" not in P.model_server_down(df, ["service"])._jdf.queryExecution().executedPlan().toString()


def test_rates_fall_to_zero_when_traffic_stops(spark):
    df = spark.createDataFrame([(1, 30_000), (2, 600_000)], "event_id INT, ms BIGINT")
    got = {r.t_ms: r.rate for r in R.count_rate(df, [], 60_000, 300_000).collect()}
    assert got == {**{60_000 * i: 1 / 300 for i in range(1, 6)}, 360_000: 0.0, **{60_000 * i: 1 / 300 for i in range(10, 15)}, 900_000: 0.0}


def test_lag_counts_rows_under_way(spark):
    df = spark.createDataFrame([(0, 10_000, 130_000), (0, 20_000, 30_000)], "source_partition BIGINT, event_ms BIGINT, arrival_ms BIGINT")
    got = [(r.t_ms, r.value) for r in P.source_lag(df).orderBy("t_ms").collect()]
    assert got == [(60_000, 1.0), (180_000, 0.0)]


def test_metric_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("x", 1.5, None)], "topic STRING, a DOUBLE, b DOUBLE")
    rows = as_metrics(df, ["a", "b"], "job-1", F.lit(7), ["topic"])
    emit_metrics(rows, str(tmp_path / "m"))
    emit_metrics(rows, str(tmp_path / "m"))
    got = read_metrics(spark, str(tmp_path / "m")).collect()
    assert [(r.metric, r.labels, r.ts_ms, r.value) for r in got] == [("a", {"job": "job-1", "topic": "x"}, 7, 1.5)] * 2


def test_reports_and_predictions_are_written(spark, tmp_path):
    rows = [(i, i, "a", 1.0, "error") for i in range(150)]
    df = spark.createDataFrame(rows, REQUEST)
    write_report(R.latency_summary(df), R.first_errors(df), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r/errors")).count() == 100
    assert spark.read.json(str(tmp_path / "r/metrics")).first().error_count == 150
    write_predictions(df, str(tmp_path / "p"))
    assert spark.read.text(str(tmp_path / "p")).where("value like '{\"event_id\":%'").count() == 150

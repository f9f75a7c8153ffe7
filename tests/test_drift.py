"""Drift measures on hand data with known answers."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardwatch.operators import drift as D
from wardwatch.operators.lateness import late_counts, late_ratio, lateness_tiers


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


@pytest.mark.parametrize(("ref", "cur", "score", "detected"), [(10, 12, 0.2, False), (10, 13, 0.3, True), (1, 50, 1.0, True), (-10, -13, 0.3, True)])
def test_mean_shift(spark, ref, cur, score, detected):
    row = D.mean_shift_drift(frame(spark, x=[float(ref)]), frame(spark, x=[float(cur)])).first()
    assert row.drift_score == pytest.approx(score) and row.drift_detected is detected


def test_mean_shift_ignores_ids_zero_means_and_missing_columns(spark):
    ref = frame(spark, patient_id=[1.0], zero=[0.0], x=[10.0], only_here=[4.0])
    cur = frame(spark, patient_id=[900.0], zero=[5.0], x=[10.0], text=["a"])
    assert D.common_columns(ref, cur) == ["zero", "x"]
    row = D.mean_shift_drift(ref, cur).first()
    assert (row.drift_score, row.drift_detected) == (0.0, False)
    nothing = D.mean_shift_drift(frame(spark, zero=[0.0]), frame(spark, zero=[5.0])).first()
    assert nothing.drift_score == 0.0


def data(spark, seed, shift=0.0, n=700):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"x": rng.normal(shift, 2, n), "y": rng.integers(0, 9, n).astype(float), "c": rng.choice(["a", "b", "c"], n, p=[0.5, 0.3, 0.2])})
    return pdf, spark.createDataFrame(pdf)


def test_no_drift_against_itself(spark):
    _, df = data(spark, 1)
    assert all(r.distance == pytest.approx(0, abs=1e-12) and not r.drifted for r in D.column_drift(df, df, ["x", "y"], ["c"]).collect())
    assert all(r.statistic == 0 and r.p_value == 1 for r in D.ks_drift(df, df, ["x", "y"]).collect())
    assert all(r.psi == pytest.approx(0, abs=1e-12) for r in D.psi_drift(df, df, ["x", "y"]).collect())
    chi2 = D.chi2_drift(df, df, ["c"]).first()
    assert chi2.statistic == pytest.approx(0) and chi2.p_value == pytest.approx(1)


def brute(a, b):
    values = np.unique(np.concatenate([a, b]))
    fa, fb = (np.searchsorted(np.sort(s), values, side="right") / len(s) for s in (a, b))
    ks = np.abs(fa - fb).max()
    area = (np.abs(fa - fb)[:-1] * np.diff(values)).sum()
    return ks, area / max(a.std(), 0.001)


@pytest.mark.parametrize("chunk", [10**9, 100])
def test_distances_match_brute_force(spark, chunk):
    pa, a = data(spark, 1)
    pb, b = data(spark, 2, shift=0.5, n=400)
    ks = {r.column: r.statistic for r in D.ks_drift(a, b, ["x", "y"], bins=None, rows_per_chunk=chunk).collect()}
    wd = {r.column: r.distance for r in D.column_drift(a, b, ["x", "y"], bins=None, rows_per_chunk=chunk).collect()}
    for c in ("x", "y"):
        want_ks, want_wd = brute(pa[c].to_numpy(), pb[c].to_numpy())
        assert ks[c] == pytest.approx(want_ks) and wd[c] == pytest.approx(want_wd)


def test_binned_distance_is_close(spark):
    _, a = data(spark, 1)
    _, b = data(spark, 2, shift=0.5)
    exact = D.column_drift(a, b, ["x"], bins=None).first().distance
    assert D.column_drift(a, b, ["x"], bins=500).first().distance == pytest.approx(exact, rel=0.05)


def test_category_distances(spark):
    ref, cur = frame(spark, c=["a"] * 50 + ["b"] * 50), frame(spark, c=["a"] * 80 + ["b"] * 20 + [None])
    p, q = np.array([0.5, 0.5]), np.array([0.8, 0.2])
    m = (p + q) / 2
    js = math.sqrt(((p * np.log2(p / m)).sum() + (q * np.log2(q / m)).sum()) / 2)
    assert D.column_drift(ref, cur, [], ["c"]).first().distance == pytest.approx(js)
    row = D.chi2_drift(ref, cur, ["c"]).first()
    assert row.statistic == pytest.approx(36.0) and row.dof == 1
    assert row.p_value == pytest.approx(1.9731752898e-9, rel=1e-6) and row.drifted


@pytest.mark.parametrize(("x", "dof", "p"), [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (2.0, 4, 0.7357588823428847), (30.0, 3, 1.3800570312932547e-06)])
def test_chi2_p_values(x, dof, p):
    assert D._upper_gamma_share(dof / 2, x / 2) == pytest.approx(p, rel=1e-8)


def test_psi_is_positive_under_drift(spark):
    _, a = data(spark, 1)
    _, b = data(spark, 2, shift=3.0)
    psi = {r.column: r.psi for r in D.psi_drift(a, b, ["x", "y"]).collect()}
    assert psi["x"] > 0.25 and 0 <= psi["y"] < 0.1


def test_count_windows_overlap_by_the_carry(spark):
    df = spark.range(2500).select(F.col("id").alias("event_id"), F.col("id").alias("arrival_ms"))
    got = {r.window_no: (r.lo, r.hi) for r in D.count_windows(df).groupBy("window_no").agg(F.min("row_no").alias("lo"), F.max("row_no").alias("hi")).collect()}
    assert got == {0: (1, 1000), 1: (901, 1900), 2: (1801, 2500)}


def test_windows_below_the_minimum_give_no_row(spark):
    df = spark.createDataFrame([(0, 1.0)] * 99 + [(1, 1.0)] * 100, "w INT, x DOUBLE")
    got = D.shift_by_window(df, ["w"], frame(spark, x=[2.0]), ["x"]).collect()
    assert [(r.w, r.drift_score) for r in got] == [(1, 0.5)]


def test_dataset_drift_is_the_share_of_drifted_columns(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (False,), (False,)], "drifted BOOLEAN")
    row = D.dataset_drift(df).first()
    assert (row.drift_score, row.drift_detected) == (0.2, False)


def test_lateness_tiers_on_hand_rows(spark):
    rows = [(1, 0, 0, 0), (2, 0, 1_000_000, 1), (3, 0, 880_000, 2), (4, 0, 879_999, 3), (5, 0, 700_000, 4), (6, 0, 699_999, 5), (7, 1, 0, 6)]
    df = spark.createDataFrame(rows, "event_id BIGINT, source_partition BIGINT, event_ms BIGINT, arrival_ms BIGINT")
    want = {1: "on_time", 2: "on_time", 3: "on_time", 4: "allowed_late", 5: "allowed_late", 6: "side_output", 7: "on_time"}
    for chunk in (10**9, 2):
        assert {r.event_id: r.tier for r in lateness_tiers(df, rows_per_chunk=chunk).collect()} == want


def test_late_ratio_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "arrival_ms BIGINT, event_ms BIGINT")
    row = late_ratio(late_counts(empty)).first()
    assert (row.total_data_count, row.late_data_count, row.late_data_ratio) == (0, 0, 0.0)


@pytest.mark.parametrize("bins", [None, 50])
def test_a_dead_sensor_and_values_that_are_no_numbers(spark, bins):
    """No current value: not comparable and not drifted; a NaN counts as missing; with nothing at all there is no row."""
    nan = float("nan")
    rows = lambda off, dead: [(float(i + off), None if dead else float(i), nan if i % 3 else float(i), None, "a" if i % 2 else "b", None if dead else "c") for i in range(200)]
    schema = "x DOUBLE, dead DOUBLE, odd DOUBLE, never DOUBLE, c STRING, gone STRING"
    ref, cur = spark.createDataFrame(rows(0, False), schema), spark.createDataFrame(rows(0, True), schema)
    numbers = ["x", "dead", "odd", "never"]
    got = {r.column: r for r in D.column_drift(ref, cur, numbers, ["c", "gone"], bins=bins).collect()}
    assert set(got) == {"x", "dead", "odd", "c", "gone"}
    assert all(got[c].distance is None and not got[c].drifted and not got[c].comparable for c in ("dead", "gone"))
    assert all(got[c].distance == 0 and got[c].comparable for c in ("x", "odd", "c"))
    ks = {r.column: r for r in D.ks_drift(ref, cur, numbers, bins=bins).collect()}
    assert (ks["dead"].statistic, ks["dead"].p_value, ks["dead"].drifted, ks["dead"].comparable) == (None, None, False, False)
    assert ks["odd"].statistic == 0 and ks["x"].comparable
    psi = {r.column: r.psi for r in D.psi_drift(ref, cur, ["x", "dead", "odd"]).collect()}
    assert psi["dead"] is None and psi["odd"] == 0 and psi["x"] == 0
    chi = {r.column: r for r in D.chi2_drift(ref, cur, ["c", "gone"]).collect()}
    assert chi["c"].statistic == 0 and not chi["gone"].drifted
    assert D.mean_shift_drift(ref, cur, ["x", "odd", "dead"]).first().drift_score == 0


def test_profile_equals_the_reference_itself(spark, tmp_path):
    """Nulls, NaNs, a constant, a column without a value on one side, a new category; versions; the plan reads no reference."""
    from wardwatch.operators import profile as P

    schema = "a DOUBLE, b INT, c DOUBLE, d DOUBLE, t STRING"
    before = spark.createDataFrame([(float(i % 50), i, 3.0, None, "xyz"[i % 3]) for i in range(400)] + [(float("nan"), None, None, None, None)], schema)
    now = spark.createDataFrame([(i % 40 + 0.5, i * 2, 3.0 + i % 2, 1.0, "xw"[i % 2]) for i in range(300)] + [(None, None, float("nan"), None, None)], schema)
    path, numbers = str(tmp_path / "profile"), ["a", "b", "c", "d"]
    P.write_profile(P.reference_profile(now, numbers, ["t"]), path, 1)
    P.write_profile(P.reference_profile(before, numbers, ["t"]), path, 2)
    rows = lambda df: sorted((r.column, r.method, None if r.distance is None else round(r.distance, 9), r.drifted, r.comparable) for r in df.collect())
    assert rows(P.column_drift_from_profile(P.read_profile(spark, path), now)) == rows(D.column_drift(before, now, numbers, ["t"]))
    assert rows(P.column_drift_from_profile(P.read_profile(spark, path, 1), before.limit(0))) == rows(D.column_drift(now, before.limit(0), numbers, ["t"]))
    assert P.read_profile(spark, path).count() < 700  # bounded by bins and categories

"""Watchers and alerts on streams: what they say equals their batch forms; timers fire without a row."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardwatch.fixtures import requests, vitals
from wardwatch.operators import alerts as A
from wardwatch.operators.drift import drift_watch, reference_means
from wardwatch.streaming import queries as S
from wardwatch.streaming import alerting
from wardwatch.streaming.alerting import AlertMachine, advance, alert_changes_stream, rule_changes_stream
from wardwatch.streaming.state import use_rocksdb
from wardwatch.streaming.watch import Watch, drift_watch_stream

COLUMNS = ["age", "bmi", "glucose_level"]
MINUTE = 60_000


def rows_of(df, *names):
    return sorted(map(str, df.select(*names).collect()))


def test_watch_in_slices_equals_whole():
    rng = np.random.default_rng(8)
    arrival = np.sort(rng.integers(0, 50_000, 3_000))
    late, values = rng.random(3_000) < 0.1, np.where(rng.random((3_000, 2)) < 0.1, np.nan, rng.normal(size=(3_000, 2)))
    limits = (2, 7_000, 300, 50, 60)
    whole = list(Watch(*limits).add(arrival, late, values))
    assert len(whole) > 10
    sliced, watch = [], Watch(*limits)
    cuts = sorted(rng.integers(0, 3_000, 9).tolist())
    for a, b in zip([0, *cuts], [*cuts, 3_000]):
        sliced += watch.add(arrival[a:b], late[a:b], values[a:b])
        watch = Watch(*limits, *watch.state(), tail=watch.tail)
    assert [r["row_no"] for r in sliced] == [r["row_no"] for r in whole]
    for a, b in zip(sliced, whole):
        np.testing.assert_allclose(a["means"], b["means"])
        assert {k: a[k] for k in a if k != "means"} == {k: b[k] for k in b if k != "means"}
    last = whole[-1]
    kept = slice(last["row_no"] - last["n_rows"], last["row_no"])
    np.testing.assert_allclose(last["means"], np.nanmean(values[kept], 0))
    assert last["late_data_count"] == late[: last["row_no"]].sum()


def test_watch_per_source_equals_batch(spark, sf_dir, tmp_path):
    """A watcher for each source, over four batches in order of arrival."""
    use_rocksdb(spark)
    rows = vitals(spark, sf_dir).drop("ts", "readmitted_30_days")
    known = reference_means(rows.where("event_id < 300"), COLUMNS)
    cuts = [float("-inf"), *rows.approxQuantile("arrival_ms", [0.25, 0.5, 0.75], 0.0), float("inf")]
    for low, high in zip(cuts, cuts[1:]):
        part = rows.where((F.col("arrival_ms") > low) & (F.col("arrival_ms") <= high))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    limits = {"timer_ms": 6 * 86_400_000, "size": 60, "carry": 20, "at_least": 30}
    checks = drift_watch_stream(source, known, COLUMNS, "source_partition", **limits)
    S.run_available(checks, S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), empty_batches=False)
    out = spark.read.parquet(str(tmp_path / "o")).withColumn("drift_score", F.round("drift_score", 9))
    names = ["row_no", "t_ms", "n_rows", "late_data_count", "drift_score", "drift_detected"]
    for n in range(4):
        own = rows.where(F.col("source_partition") == n)
        want = drift_watch(own, known, COLUMNS, **limits).withColumn("drift_score", F.round("drift_score", 9))
        # The rows after the last full check wait for the timer.
        total = own.count()
        assert rows_of(out.where(F.col("source_partition") == str(n)), *names) == rows_of(want.where((F.col("row_no") < total) | (F.col("n_rows") == 60)), *names)


def test_timer_checks_without_rows(spark, tmp_path):
    """150 rows fill no window; the check comes when the timer of the wall clock runs out."""
    use_rocksdb(spark)
    rows = spark.range(150).selectExpr("id event_id", "1000 + id arrival_ms", "1000 + id event_ms", "cast(id as double) x")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    checks = drift_watch_stream(source, {"x": 74.5}, ["x"], idle_ms=500)
    query = S.checkpointed(checks, S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), trigger="300 milliseconds")
    try:
        for _ in range(100):
            time.sleep(0.3)
            found = spark.read.schema("row_no BIGINT, n_rows BIGINT, drift_score DOUBLE").parquet(str(tmp_path / "o")).collect() if (tmp_path / "o").exists() else []
            if found:
                break
    finally:
        query.stop()
    assert [(r.row_no, r.n_rows, r.drift_score) for r in found] == [(150, 150, 0.0)]


def test_machine_by_hand():
    def run(samples, upto, hold=100, gap=60):
        waiting = {t: (float(on), bool(on)) for t, on in samples}
        return [(at, state) for at, state, _, _ in advance(AlertMachine(hold, gap), waiting, upto)]

    steady = [(t, 1) for t in range(0, 200, 50)]
    assert run(steady, 400) == [(0, "pending"), (100, "firing"), (210, "resolved")]
    assert run(steady, 150) == [(0, "pending"), (100, "firing")]
    assert run([(0, 1), (50, 1), (100, 0)], 400) == [(0, "pending"), (100, "inactive")]  # the sample at the deadline comes first
    assert run([(0, 1), (50, 1), (101, 0)], 400) == [(0, "pending"), (100, "firing"), (101, "resolved")]  # fires between two samples
    assert run([(0, 1), (50, 1)], 400) == [(0, "pending"), (100, "firing"), (110, "resolved")]  # without a further sample
    assert run([(0, 1)], 400) == [(0, "pending"), (60, "inactive")]
    assert run([(0, 1), (200, 1)], 250) == [(0, "pending"), (60, "inactive"), (200, "pending")]
    assert run([(0, 1), (10, 0)], 400, hold=0) == [(0, "firing"), (10, "resolved")]


def test_machine_in_slices_equals_whole():
    rng = random.Random(6)
    for _ in range(200):
        samples = {t: (float(t), rng.random() < 0.8) for t in rng.sample(range(600), 40)}
        whole = list(advance(AlertMachine(70, 30), dict(samples), 700))
        machine, waiting, out = AlertMachine(70, 30), {}, []
        for upto in (100, 250, 251, 480, 700):
            waiting |= {t: s for t, s in samples.items() if t <= upto}
            out += advance(machine, {t: s for t, s in waiting.items()}, upto)
            waiting = {}
            samples = {t: s for t, s in samples.items() if t > upto}
        assert out == whole


class Calls(dict):
    """A map in the state store that counts its calls."""

    n = 0

    def _one(self, out):
        self.n += 1
        return out

    def getValue(self, key):
        return self._one(self[key])

    def updateValue(self, key, value):
        self._one(self.__setitem__(key, value))

    def removeKey(self, key):
        self._one(self.__delitem__(key))


def test_many_waiting_samples_cost_few_calls():
    """A series of 300,000 samples in no order waits in chunks; a slice of it is taken without reading the rest."""
    rng = np.random.default_rng(4)
    rows = np.zeros(300_000, alerting.SAMPLE)
    rows["at"], rows["value"], rows["holds"] = rng.permutation(300_000), rng.random(300_000), 1
    state = Calls()
    for part in np.split(rows, 3):
        alerting.Waiting(state).put(part)
    assert state.n < 300
    state.n, taken = 0, {}
    for samples in alerting.Waiting(state).take(99_999):
        taken |= samples
    assert list(taken) == list(range(100_000)) and state.n < 30
    assert sum(len(v[0]) for v in state.values()) == 200_000 * alerting.SAMPLE.itemsize


def test_waiting_chunks_equal_a_map(monkeypatch):
    """Small chunks, repeated times, values that miss: of one time the largest waits, whatever order they come in."""
    monkeypatch.setattr(alerting, "CHUNK", 3)
    rng, state, want = random.Random(3), Calls(), {}

    def rank(sample):
        return sample[0] is not None, sample[0] or 0.0, sample[1]

    for _ in range(60):
        new = [(rng.randrange(200), rng.choice([None, float("inf"), -1.5, 0.0, 2.0]), rng.random() < 0.5) for _ in range(rng.randrange(1, 12))]
        for at, *sample in new:
            want[at] = max(want.get(at, tuple(sample)), tuple(sample), key=rank)
        rows = [(at, np.nan if value is None else value, on) for at, value, on in new]
        alerting.Waiting(state).put(np.array(rows, alerting.SAMPLE))
        upto = rng.randrange(250) if rng.random() < 0.3 else -1
        taken = {}
        for samples in alerting.Waiting(state).take(upto):
            taken |= samples
        assert list(taken) == sorted(t for t in want if t <= upto)
        assert taken == {t: want.pop(t) for t in sorted(want) if t <= upto}
        assert alerting.Waiting(state).starts == sorted(k[0] for k in state)


@pytest.fixture(scope="module")
def series(spark, sf_dir):
    rows = requests(spark, sf_dir).groupBy("source", F.col("ms").alias("t_ms")).agg(F.max("latency_ms").alias("value"))
    return rows.cache()


def test_changes_on_a_grid_equal_the_states(spark):
    """Where samples are regular and the hold a multiple of their step, the changes are those of `alert_hold`."""
    rng = random.Random(1)
    rows = [(k, t * MINUTE, float(rng.random() < 0.85)) for k in "ab" for t in range(300)]
    df = spark.createDataFrame(rows, "source string, t_ms bigint, value double").cache()
    states = A.alert_hold(df, ["source"], F.col("value") > 0, 3 * MINUTE, max_gap_ms=MINUTE).orderBy("source", "t_ms").collect()
    want, before = [], {}
    for r in states:
        if before.get(r.source, "inactive") != r.state:
            want.append((r.source, r.t_ms, r.state))
        before[r.source] = r.state
    changes = A.alert_changes(df, ["source"], F.col("value") > 0, 3 * MINUTE, max_gap_ms=MINUTE).collect()
    got = {(r.source, r.at_ms, "inactive" if r.state == "resolved" else r.state) for r in changes}
    # A run that ends and begins anew in one sample of a grid does not occur: a false sample lies between.
    assert sorted(got) == sorted(want)


def test_alerts_of_shuffled_batches_equal_batch(spark, series, tmp_path):
    """Samples come in no order within the delay; firing and going stale need no sample."""
    use_rocksdb(spark)
    for i in range(4):
        series.where(F.pmod(F.hash("t_ms"), F.lit(4)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(series.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    hour = 60 * MINUTE
    rule = A.AlertRule("SlowRequests", 20, 24 * hour, "warning", "latency is %.1f ms")
    changes = rule_changes_stream(source, rule, ["source"], 12 * hour, "40 days")
    S.run_available(changes, S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), empty_batches=True)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 0  # the watermark has not come to the first sample
    # One sample far ahead, of another series, moves the watermark past all others.
    end = series.agg(F.max("t_ms")).first()[0]
    ahead = spark.createDataFrame([("z", end + 50 * 24 * hour, 0.0)], series.schema)
    ahead.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    S.run_available(changes, S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), empty_batches=True)
    want = A.alert_changes(series, ["source"], F.col("value") > 20, 24 * hour, end + 10 * 24 * hour, max_gap_ms=12 * hour)
    out = spark.read.parquet(str(tmp_path / "o"))
    names = ["source", "at_ms", "state", "since_ms", "value"]
    assert rows_of(out, *names) == rows_of(want, *names) and out.count() > 100
    assert out.where("state = 'firing'").count() > 0
    assert out.where("state IN ('pending', 'firing') AND description IS NULL").count() == 0


def test_series_without_keys(spark, tmp_path):
    use_rocksdb(spark)
    at = [(t * MINUTE, v) for t, v in ((5, 1.0), (6, None), (7, 1.0), (15, 0.0))]
    rows = spark.createDataFrame(at, "t_ms bigint, value double")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    changes = alert_changes_stream(source, [], F.col("value") > 0, MINUTE, 2 * MINUTE, "0 seconds")
    S.run_available(changes, S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), empty_batches=True)
    got = sorted((r.at_ms // MINUTE, r.state) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == [(5, "pending"), (6, "inactive"), (7, "pending"), (8, "firing"), (9, "resolved")]
    want = A.alert_changes(rows, [], F.col("value") > 0, MINUTE, max_gap_ms=2 * MINUTE)
    assert sorted((r.at_ms // MINUTE, r.state) for r in want.collect()) == got

"""Streams against their batch twins, restarts, replays and metrics."""

import pytest
from pyspark.sql import functions as F

from wardwatch.fixtures import vitals
from wardwatch.operators.history import DAY_MS, feature_rows, latest_per_patient, recent_history, vitals_delta
from wardwatch.operators.lateness import lateness_tiers
from wardwatch.operators.reconcile import reconcile
from wardwatch.operators.scoring import score_request, successful_only
from wardwatch.schemas import METRICS
from wardwatch.sinks.snapshots import read_version, update_version, versions
from wardwatch.sinks.tables import latest_revision
from wardwatch.sources.vitals import decode_topic, predictions_table, vitals_stream
from wardwatch.streaming import queries as S
from wardwatch.streaming.progress import ProgressMetrics, progress_rows
from wardwatch.streaming.state import Readings, patient_state_stream, use_rocksdb
from wardwatch.streaming.windows import tumbling_vitals


@pytest.fixture(scope="module")
def feed(spark, sf_dir, tmp_path_factory):
    """Vitals as four files in order of arrival, the file times in that order too."""
    import os
    import shutil

    base = tmp_path_factory.mktemp("feed")
    rows = vitals(spark, sf_dir).drop("ts", "readmitted_30_days")
    cut = rows.approxQuantile("arrival_ms", [0.25, 0.5, 0.75], 0.0)
    bounds = [float("-inf"), *cut, float("inf")]
    folder = base / "files"
    folder.mkdir()
    for i in range(4):
        part = rows.where((F.col("arrival_ms") > bounds[i]) & (F.col("arrival_ms") <= bounds[i + 1]))
        part.coalesce(1).write.parquet(str(base / f"part{i}"))
        source = next((base / f"part{i}").glob("*.parquet"))
        shutil.copy(source, folder / f"{i}.parquet")
        os.utime(folder / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder), rows.cache()


def stream(spark, folder, files=1):
    return vitals_stream(spark, folder, schema=spark.read.parquet(folder).schema, files_per_trigger=files)


def same(a, b, columns):
    left = sorted(map(str, a.select(*columns).collect()))
    right = sorted(map(str, b.select(*columns).collect()))
    assert len(left) == len(right) and left == right


def test_scoring_stream_equals_batch(spark, feed, tmp_path):
    folder, rows = feed
    base = str(tmp_path)
    paths = S.ScoringPaths(f"{base}/p", f"{base}/d", f"{base}/f", f"{base}/h")
    S.run_available(stream(spark, folder), S.scoring_writer(paths, ttl_ms=10**15, keep=5), f"{base}/c")
    scored = score_request(rows)
    assert predictions_table(spark, paths.predictions).count() == successful_only(scored).count()
    assert predictions_table(spark, paths.predictions).select("batch_id").distinct().count() == 4
    assert spark.read.parquet(paths.dead_letters).count() == scored.where("error is not null").count()
    columns = ["patient_id", "event_id", "event_ms", "anomaly"]
    same(S.features_table(paths.features).read(spark), latest_per_patient(feature_rows(scored)), columns)
    same(S.history_table(paths.history, 5).read(spark), recent_history(feature_rows(scored), 5), columns)


def test_restart_loses_and_repeats_nothing(spark, feed, tmp_path):
    """The first run dies in its third batch, after the batch was written and before it was committed."""
    folder, rows = feed
    base = str(tmp_path)
    paths = S.ScoringPaths(f"{base}/p", f"{base}/d", f"{base}/f", f"{base}/h")
    write = S.scoring_writer(paths, ttl_ms=10**15, keep=5)

    def dies(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        S.run_available(stream(spark, folder), dies, f"{base}/c")
    assert S.features_table(paths.features).versions(spark) == [0, 1, 2]
    S.run_available(stream(spark, folder), write, f"{base}/c")
    good = successful_only(score_request(rows))
    row = reconcile(good, predictions_table(spark, paths.predictions)).first()
    assert (row.missing, row.duplicates, row.all_processed) == (0, 0, True)
    same(S.history_table(paths.history, 5).read(spark), recent_history(feature_rows(score_request(rows)), 5), ["patient_id", "event_id"])


def test_lateness_stream_equals_batch(spark, feed, tmp_path):
    folder, rows = feed
    base = str(tmp_path)
    S.run_available(stream(spark, folder), S.lateness_writer(f"{base}/m", f"{base}/s", f"{base}/w"), f"{base}/c")
    both = spark.read.parquet(f"{base}/m").unionByName(spark.read.parquet(f"{base}/s"))
    same(both, lateness_tiers(rows), ["event_id", "behind_ms", "tier"])
    assert spark.read.parquet(f"{base}/s").where("tier <> 'side_output'").count() == 0


def test_patient_state_equals_batch_on_ordered_input(spark, feed, tmp_path):
    folder, _ = feed
    use_rocksdb(spark)
    base = str(tmp_path)
    rows = spark.read.parquet(folder)
    in_order = rows.withColumn("event_ms", F.col("arrival_ms"))
    source = stream(spark, folder).withColumn("event_ms", F.col("arrival_ms"))
    S.run_available(patient_state_stream(score_request(source), DAY_MS), S.table_writer(f"{base}/o"), f"{base}/c", empty_batches=False)
    columns = ["event_id", "previous_ms", "glucose_change", "bp_change", "diastolic_change", "previous_readmission_risk", "previous_anomaly"]
    same(spark.read.parquet(f"{base}/o"), vitals_delta(score_request(in_order), DAY_MS), columns)


def test_changes_of_a_busy_patient_equal_batch(spark, feed, tmp_path):
    folder, _ = feed
    base = str(tmp_path)

    def busy(df):
        name = F.when(F.col("gender") == "Male", F.lit("busy")).otherwise(F.col("patient_id"))
        return df.withColumn("patient_id", name).withColumn("event_ms", F.col("arrival_ms"))

    write = S.delta_writer(f"{base}/o", f"{base}/s", ttl_ms=DAY_MS)
    S.run_available(busy(stream(spark, folder)), write, f"{base}/c")
    columns = ["event_id", "previous_ms", "glucose_change", "bp_change", "diastolic_change", "previous_readmission_risk", "previous_anomaly"]
    same(spark.read.parquet(f"{base}/o"), vitals_delta(score_request(busy(spark.read.parquet(folder))), DAY_MS), columns)


def test_state_ends_after_a_gap_in_event_time(spark, tmp_path):
    use_rocksdb(spark)
    schema = "event_id BIGINT, patient_id STRING, age BIGINT, blood_pressure STRING, bmi DOUBLE, glucose_level DOUBLE, event_ms BIGINT, arrival_ms BIGINT"
    folder = str(tmp_path / "in")
    for i, ms in enumerate([0, 60_000, 120_001]):
        spark.createDataFrame([(i, "a", 50, "120/80", 25.0, 100.0 + i, ms, ms)], schema).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(schema).parquet(folder)
        S.run_available(patient_state_stream(score_request(source), 60_000), S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), empty_batches=False)
    got = {r.event_id: r.glucose_change for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {0: None, 1: 1.0, 2: None}


def test_shuffled_arrival_over_batches_equals_batch(spark, sf_dir, tmp_path):
    """Rows come in no order at all over four batches; late ones meet their true predecessor and revise their successor."""
    use_rocksdb(spark)
    rows = vitals(spark, sf_dir).drop("ts", "readmitted_30_days").withColumn("patient_id", (F.col("event_id") % 7).cast("string"))
    for i in range(4):
        rows.where(F.pmod(F.hash("event_id"), F.lit(4)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    changes = patient_state_stream(score_request(stream(spark, str(tmp_path / "in"))), DAY_MS, late_ms=10**12)
    S.run_available(changes, S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), empty_batches=False)
    written = spark.read.parquet(str(tmp_path / "o"))
    assert written.select("batch_id").distinct().count() == 4 and written.count() > rows.count()
    columns = ["event_id", "previous_ms", "glucose_change", "bp_change", "diastolic_change", "previous_readmission_risk", "previous_anomaly", "error"]
    same(latest_revision(written, ["patient_id", "event_id"]), vitals_delta(score_request(rows), DAY_MS), columns)


def _frames(rng, n, size=100_000):
    import pandas as pd

    for start in range(0, n, size):
        m = min(size, n - start)
        yield pd.DataFrame(
            {
                "event_id": range(start, start + m),
                "event_ms": rng.integers(0, 10**8, m),
                "glucose_level": rng.normal(100, 9, m),
                "systolic": 120.0,
                "diastolic": 80.0,
                "risk_score": rng.random(m),
                "anomaly": rng.random(m) < 0.2,
                "error": [None if e else "bad" for e in rng.random(m) < 0.99],
            }
        )


def test_two_million_rows_of_one_patient_fit(spark):
    import tracemalloc

    import numpy as np

    tracemalloc.start()
    out, _ = Readings({}, 10**8, 0).add(_frames(np.random.default_rng(1), 2_000_000), None)
    n = sum(len(frame) for frame in out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2_000_000 and peak < 10**9


def test_patients_of_a_bucket_equal_patients_alone():
    """Rows of several patients in no order over many batches, with errors, repeats and nulls; each as if it were alone."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    names = np.array(["a", "b", "c", None], object)
    together, alone = {}, {name: {} for name in names}
    newest, newest_alone = None, dict.fromkeys(names)

    def said(frames):
        rows = [r for f in frames for r in f.drop(columns="patient_id").astype(object).itertuples(index=False)]
        return sorted(str(tuple(None if pd.isna(x) else x for x in r)) for r in rows)

    revised = 0
    for batch in range(80):
        n = int(rng.integers(1, 12))
        frame = pd.DataFrame(
            {
                "patient_id": names[rng.integers(0, 4, n)],
                "event_id": pd.array(rng.integers(0, 1_000, n), "Int64"),
                "event_ms": pd.array(batch * 12 + rng.integers(-150, 10, n), "Int64"),
                "glucose_level": rng.normal(100, 9, n),
                "systolic": 120.0,
                "diastolic": 80.0,
                "risk_score": rng.random(n),
                "anomaly": rng.random(n) < 0.2,
                "error": [None if e else rng.choice(["bad", "worse"]) for e in rng.random(n) < 0.7],
            }
        )
        frame.loc[rng.random(n) < 0.03, "event_ms"] = pd.NA
        out, newest = Readings(together, 100, 50).add(iter([frame]), newest)
        out = list(out)
        for name in names:
            own = frame[frame["patient_id"].isna() if name is None else frame["patient_id"] == name]
            if len(own):
                one, newest_alone[name] = Readings(alone[name], 100, 50).add(iter([own.drop(columns="patient_id")]), newest_alone[name])
                want = said(one)
                revised += len(want) > len(own)
            else:
                want = []
            got = [f[f["patient_id"].isna() if name is None else f["patient_id"] == name] for f in out]
            assert said(got) == want
    assert revised > 10 and {p for parts in alone.values() for p in parts} == set(together)


def test_many_patients_share_state_and_frames(spark, tmp_path):
    """2,000 patients of two readings: one call of the state and one frame for each bucket, not for each patient."""
    calls = []

    class Counted(dict):
        def __setitem__(self, part, value):
            calls.append(part)
            super().__setitem__(part, value)

    import numpy as np

    frame = next(_frames(np.random.default_rng(2), 4_000)).assign(patient_id=[str(i % 2_000) for i in range(4_000)])
    out, newest = Readings(Counted(), 10**8, 0).add(iter([frame]), None)
    assert [len(f) for f in out] == [4_000] and calls == [0] and len(newest) == 2_000


def test_old_parts_go_and_late_rows_revise(spark):
    import numpy as np
    import pandas as pd

    def send(store, newest, *rows):
        frame = pd.DataFrame(rows, columns=["event_id", "event_ms", "glucose_level", "error"])
        frame = frame.assign(systolic=np.nan, diastolic=np.nan, risk_score=0.5, anomaly=None)
        out, newest = Readings(store, 100, 50).add(iter([frame]), newest)
        return {r.event_id: None if pd.isna(r.previous_ms) else r.previous_ms for f in out for r in f.itertuples()}, newest

    store = {}
    got, newest = send(store, None, (1, 10, 1.0, None), (2, 90, 2.0, None), (3, 95, 2.0, "bad"))
    assert got == {1: None, 2: 10, 3: 90}
    got, newest = send(store, newest, (4, 50, 3.0, None))
    assert got == {4: 10, 2: 50}  # the row between comes out again, the one behind the next good row does not
    got, newest = send(store, newest, (5, 60, 3.0, "bad"), (2, 90, 2.0, None))
    assert got == {5: 50, 2: 50}
    got, newest = send(store, newest, (6, 400, 1.0, None), (7, None, 1.0, None))
    assert got == {6: None, 7: None} and all((p + 1) * 100 > 400 - 150 for p in store)


def test_windows_keep_late_revisions(spark, feed, tmp_path):
    folder, rows = feed
    base = str(tmp_path)
    S.run_available(tumbling_vitals(stream(spark, folder), "1 hour", delay="60 days"), S.table_writer(f"{base}/o"), f"{base}/c", "update")
    out = latest_revision(spark.read.parquet(f"{base}/o"), ["window_ms", "discharge_destination"])
    same(out, tumbling_vitals(rows, "1 hour"), ["window_ms", "discharge_destination", "n", "max_bmi", "max_delay_ms"])


def test_dedupe_across_batches(spark, feed, tmp_path):
    folder, rows = feed
    base = str(tmp_path)
    twice = stream(spark, folder).unionByName(stream(spark, folder))
    S.run_available(S.dedupe_stream(twice, delay="60 days").select("event_id"), S.table_writer(f"{base}/o"), f"{base}/c")
    same(spark.read.parquet(f"{base}/o"), rows, ["event_id"])


def test_drift_stream_equals_batch(spark, feed, tmp_path):
    from wardwatch.plans.alerting import drift_series

    folder, rows = feed
    base = str(tmp_path)
    columns = ["age", "bmi", "glucose_level"]
    reference = rows.where("event_id < 300")
    windows = S.drift_stream(stream(spark, folder), columns, "7 days", "60 days")
    S.run_available(windows, S.drift_writer(f"{base}/o", reference, columns), f"{base}/c", "update")
    out = latest_revision(spark.read.parquet(f"{base}/o"), ["window_ms"]).withColumn("drift_score", F.round("drift_score", 9))
    batch = rows.withColumn("event_ms", F.col("event_ms"))
    want = drift_series(batch, reference, columns, 7 * DAY_MS).withColumn("drift_score", F.round("drift_score", 9))
    same(out, want.withColumnRenamed("t_ms", "window_ms"), ["window_ms", "n_rows", "drift_score", "drift_detected"])


def test_snapshot_replay_and_retention(spark, tmp_path):
    path = str(tmp_path / "t")

    def add(n):
        return lambda old: old.unionByName(spark.createDataFrame([(n,)], "k BIGINT"))

    for n in range(6):
        update_version(spark, path, "k BIGINT", n, add(n), keep=3)
    assert versions(spark, path) == [3, 4, 5]
    update_version(spark, path, "k BIGINT", 5, add(50), keep=3)
    assert sorted(r.k for r in read_version(spark, path, "k BIGINT").collect()) == [0, 1, 2, 3, 4, 50]
    assert read_version(spark, str(tmp_path / "none"), "k BIGINT").count() == 0


def test_json_files_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text('{"patient_id":1,"age":50,"blood_pressure":"130/72","bmi":31.5,"timestamp":1700000000000}\nbroken\n')
    rows = vitals_stream(spark, str(tmp_path / "in"), fmt="text")
    S.run_available(rows, S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"))
    row = spark.read.parquet(str(tmp_path / "o")).first()
    assert row.event_ms == 1700000000000 and row.arrival_ms > row.event_ms


def test_topic_records_decode(spark):
    raw = spark.sql("""select cast('{"patient_id":"p","ts":5}' as binary) value, timestamp '2024-01-01 00:00:01' timestamp, 3 partition""")
    row = decode_topic(raw).first()
    assert (row.patient_id, row.event_ms, row.source_partition, row.arrival_ms) == ("p", 5, 3, 1704067201000)


def test_progress_report_becomes_metrics(spark, tmp_path):
    report = {
        "name": "q",
        "timestamp": "2024-01-01T00:00:10.000Z",
        "numInputRows": 5,
        "durationMs": {"walCommit": 7, "commitOffsets": 3, "triggerExecution": 50},
        "eventTime": {"max": "2024-01-01T00:00:00.000Z"},
        "stateOperators": [{"operatorName": "s", "memoryUsedBytes": 100, "numRowsTotal": 2}],
        "sources": [{"latestOffset": {"t": {"0": 12, "1": 4}}, "endOffset": {"t": {"0": 10}}}],
    }
    got = {(m, labels.get("partition")): v for m, labels, _, v in progress_rows(report)}
    assert got[("checkpoint_duration_ms", None)] == 10 and got[("event_time_lag_ms", None)] == 10_000
    assert got[("state_size_bytes", None)] == 100
    assert (got[("kafka_consumergroup_lag", "0")], got[("kafka_consumergroup_lag", "1")]) == (2, 4)
    collector = ProgressMetrics()
    collector.rows.extend(progress_rows(report))
    assert collector.table(spark).schema == METRICS
    collector.flush(spark, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).where("metric = 'input_rows_total'").first().value == 5


def test_running_query_reports_state_and_checkpoint(spark, feed, tmp_path):
    import time

    folder, _ = feed
    collector = ProgressMetrics()
    spark.streams.addListener(collector)
    try:
        S.run_available(tumbling_vitals(stream(spark, folder), "1 day"), S.table_writer(str(tmp_path / "o")), str(tmp_path / "c"), "update")
        for _ in range(50):
            if {"state_size_bytes", "checkpoint_duration_ms"} <= {r[0] for r in collector.rows}:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(collector)
    assert {"state_size_bytes", "state_rows", "checkpoint_duration_ms", "input_rows_total"} <= {r[0] for r in collector.rows}


def test_clock_far_ahead_expires_nobody(spark, feed, tmp_path):
    """Its event is a dead letter; the other patients keep their features and their last reading."""
    folder, rows = feed
    base = spark.read.parquet(folder).where("blood_pressure <> 'n/a'").limit(1)
    minute = 60_000

    def send(i, *events):
        made = None
        for patient, ms, arrival in events:
            one = base.withColumns({"patient_id": F.lit(patient), "event_ms": F.lit(ms).cast("bigint"), "arrival_ms": F.lit(arrival), "event_id": F.lit(i * 10 + len(patient))})
            made = one if made is None else made.unionByName(one)
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    t = 1_700_000_000_000
    send(1, ("a", t, t))
    send(2, ("z", t + 10**12, t + minute), ("nn", None, t + minute))
    send(3, ("a", t + minute, t + minute))
    paths = S.ScoringPaths(*[str(tmp_path / p) for p in ("predictions", "dead", "features", "history")])
    S.run_available(stream(spark, str(tmp_path / "in")), S.scoring_writer(paths), str(tmp_path / "c1"))
    assert [r.patient_id for r in S.features_table(paths.features).read(spark).collect()] == ["a"]
    assert {r.error for r in spark.read.parquet(paths.dead_letters).collect()} == {"event_time_ahead", "missing_event_time"}
    S.run_available(stream(spark, str(tmp_path / "in")), S.delta_writer(str(tmp_path / "changes"), str(tmp_path / "state")), str(tmp_path / "c2"))
    changed = {(r.patient_id, r.event_id): r.previous_ms for r in spark.read.parquet(str(tmp_path / "changes")).collect()}
    assert changed["a", 31] == t and changed["z", 21] is None
    use_rocksdb(spark)
    kept = patient_state_stream(score_request(stream(spark, str(tmp_path / "in"))))
    S.run_available(kept, S.table_writer(str(tmp_path / "kept")), str(tmp_path / "c3"), empty_batches=False)
    assert {r.event_id: r.previous_ms for r in spark.read.parquet(str(tmp_path / "kept")).where("patient_id = 'a'").collect()} == {11: None, 31: t}


def test_no_metric_row_is_lost(spark, tmp_path):
    listener = ProgressMetrics()
    listener.rows += [("m", {"query": "q"}, i, float(i)) for i in range(200_000)]
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    with pytest.raises(Exception):
        listener.flush(spark, f"{blocked}/metrics")
    assert len(listener.rows) == 200_000
    listener.flush(spark, str(tmp_path / "metrics"))
    assert not listener.rows and spark.read.parquet(str(tmp_path / "metrics")).count() == 200_000


def test_checkpoint_older_than_all_versions_is_an_error(spark, tmp_path):
    for batch in range(3, 7):
        update_version(spark, str(tmp_path / "t"), "a INT", batch, lambda old: old) if batch > 3 else spark.createDataFrame([(1,)], "a INT").write.parquet(str(tmp_path / "t/version=3"))
    with pytest.raises(ValueError, match="no version before batch 2"):
        read_version(spark, str(tmp_path / "t"), "a INT", before=2)
    assert read_version(spark, str(tmp_path / "new"), "a INT", before=2).count() == 0


def test_start_policies(spark, tmp_path):
    from wardwatch.sources.vitals import start_options

    assert start_options("latest-offset") == {"startingOffsets": "latest"} and start_options("earliest", "parquet") == {}
    with pytest.raises(ValueError, match="needs a topic"):
        vitals_stream(spark, str(tmp_path), starting="latest")
    with pytest.raises(ValueError, match="one of"):
        start_options("middle")


def test_no_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from wardwatch.session import work_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: ""), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(cluster, "x")

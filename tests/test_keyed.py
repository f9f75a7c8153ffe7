"""Keyed tables of merged runs: contents, replays, and bytes that follow the batch."""

import random
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardwatch.sinks import keyed
from wardwatch.sinks.keyed import KeyedTable, Manifest, Segment, bite, crowded_range

SCHEMA = "patient_id STRING, n INT"


def newest(rows):
    return rows.groupBy("patient_id").agg(F.max("n").alias("n"))


@pytest.fixture
def table(tmp_path):
    return partial(KeyedTable, str(tmp_path / "t"), SCHEMA, "patient_id", newest)


def frame(spark, pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def bytes_of(path, batch):
    return sum(f.stat().st_size for d in Path(path).glob(f"segment={batch}_*") for f in d.glob("*.parquet"))


def contents(df):
    return {r.patient_id: r.n for r in df.collect()}


def test_contents_replays_and_retention(spark, table, monkeypatch):
    monkeypatch.setattr(keyed, "LEVEL_ROWS", 10)
    t = table(segment_rows=15, runs=3, keep=3)
    rng, want, states = random.Random(4), {}, []
    for batch in range(11):
        pairs = [(f"p{rng.randint(0, 60)}", batch * 100 + i) for i in range(rng.randint(0, 12))]
        if batch == 5:
            pairs = [(f"p{i}", 500) for i in range(120)]
        t.update(spark, batch, frame(spark, pairs))
        for k, n in pairs:
            want[k] = max(n, want.get(k, -1))
        states.append(dict(want))
    assert contents(t.read(spark)) == want
    assert contents(t.read(spark, before=10)) == states[9]
    levels = {s.level for s in t.manifest(spark).segments}
    assert max(levels) >= 2 and any(not s.whole for s in t.manifest(spark).segments)
    before = t.manifest(spark)
    t.update(spark, 10, frame(spark, pairs))
    assert t.manifest(spark) == before and contents(t.read(spark)) == want
    some = frame(spark, [("p1", 0), ("p7", 0), ("nobody", 0)])
    assert contents(t.read(spark, keys=some)) == {k: want[k] for k in ("p1", "p7")}
    assert t.versions(spark) == [8, 9, 10]
    held = {s.name for v in t.versions(spark) for s in t.manifest(spark, v + 1).segments}
    assert {d.name.partition("=")[2] for d in Path(t.path).glob("segment=*")} == held
    with pytest.raises(ValueError, match="no version before batch 5"):
        t.read(spark, before=5)
    t.update(spark, 11, frame(spark, [("p1", 9_999)]), live=F.col("n") >= 9_000)
    assert contents(t.read(spark))["p1"] == 9_999


def test_bytes_follow_the_batch_not_the_table(spark, tmp_path, monkeypatch):
    """Two tables, one forty times the other: eight batches of 50 rows write nearly the same bytes to both."""
    monkeypatch.setattr(keyed, "LEVEL_ROWS", 100)
    written = {}
    for size in (2_000, 80_000):
        t = KeyedTable(str(tmp_path / str(size)), SCHEMA, "patient_id", newest, segment_rows=2_000, runs=4)
        t.update(spark, 0, spark.range(size).select(F.concat(F.lit("p"), "id").alias("patient_id"), F.lit(0).alias("n")))
        each = []
        for batch in range(1, 9):
            t.update(spark, batch, spark.range(50).select(F.concat(F.lit("p"), F.col("id") * 31 + batch).alias("patient_id"), F.lit(batch).alias("n")))
            each.append(bytes_of(t.path, batch))
        written[size] = each
        assert t.read(spark).count() >= size
        assert max(each) < bytes_of(t.path, 0) or size == 2_000
    assert sum(written[80_000]) < 1.3 * sum(written[2_000])
    assert max(written[80_000]) < 1.5 * max(written[2_000])


def test_large_runs_are_merged_in_pieces(spark, tmp_path, monkeypatch):
    """Runs of 3,000 rows are merged 1,000 rows at a time; a reader of one key opens few of the pieces."""
    monkeypatch.setattr(keyed, "LEVEL_ROWS", 10)
    t = KeyedTable(str(tmp_path / "t"), SCHEMA, "patient_id", newest, segment_rows=1_000, runs=2)
    for batch in range(4):
        t.update(spark, batch, spark.range(3_000).select(F.concat(F.lit("p"), "id").alias("patient_id"), F.lit(batch).alias("n")))
    segments = t.manifest(spark).segments
    assert len([s for s in segments if s.rows <= 1_100]) >= 4
    assert set(contents(t.read(spark)).values()) == {3} and t.read(spark).count() == 3_000
    opened = t.read(spark, keys=frame(spark, [("p5", 0)]))
    assert contents(opened) == {"p5": 3}
    assert len(opened.inputFiles()) < len(t.read(spark).inputFiles())


def test_ranges():
    whole = lambda name, low, high, rows=100: Segment(name, 0, low, high, rows)
    a, b, c = whole("a", 0, 99), whole("b", 50, 149), whole("c", 60, 70)
    assert crowded_range([a, b, c], 3) == (60, 70) and crowded_range([a, b, c], 2) == (50, 99) and crowded_range([a, b], 3) is None
    assert [(s.low, s.high, s.rows, s.whole) for s in a.without(60, 70)] == [(0, 59, 60, False), (71, 99, 29, False)]
    assert a.without(200, 300) == [a] and a.without(0, 99) == []
    assert bite([a, b], 50, 99, 10) == 54 and bite([a], 0, 99, 1_000) == 99
    m = Manifest((a, *b.without(60, 70)), 7)
    assert Manifest.of(m.text()) == m

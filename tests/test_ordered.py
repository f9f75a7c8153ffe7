"""Chunked scans and exact percentiles against brute force, with one group holding a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardwatch.operators import ordered
from wardwatch.operators.ordered import Scan, ordered_scan, plan_splits
from wardwatch.operators.quantiles import percentiles

def scans():
    third = F.when(F.col("v") % 3 == 0, F.col("v"))
    return {
        "n": Scan("count"),
        "n_before": Scan("count", inclusive=False),
        "total": Scan("sum", F.col("v")),
        "total_before": Scan("sum", F.col("v"), inclusive=False),
        "top": Scan("max", F.col("v")),
        "top_before": Scan("max", F.col("v"), inclusive=False),
        "last": Scan("last", third),
        "last_before": Scan("last", third, inclusive=False),
        "gained": Scan("increase", third.cast("double")),
    }


def rows(n, seed=0, same_time=False):
    rng = np.random.default_rng(seed)
    groups = np.where(np.arange(n) % 3 == 0, "busy", rng.choice(list("abcdefg"), n))
    t = np.zeros(n, int) if same_time else rng.integers(0, n // 4 + 1, n)
    return pd.DataFrame({"g": groups, "t": t, "id": rng.permutation(n), "v": rng.integers(-50, 50, n)})


def expected(pdf):
    out = []
    for _, g in pdf.sort_values(["t", "id"]).groupby("g", dropna=False):
        g = g.copy()
        hit = g["v"].where(g["v"] % 3 == 0)
        g["n"] = range(1, len(g) + 1)
        g["n_before"] = range(len(g))
        g["total"] = g["v"].cumsum()
        g["total_before"] = g["v"].cumsum().shift(1)
        g["top"] = g["v"].cummax()
        g["top_before"] = g["v"].cummax().shift(1)
        g["last"] = hit.ffill()
        g["last_before"] = hit.shift(1).ffill()
        seen = hit.dropna()
        step = seen.diff().where(seen >= seen.shift(1), seen).where(seen.shift(1).notna(), 0)
        g["gained"] = step.reindex(g.index).fillna(0).cumsum()
        out.append(g)
    return pd.concat(out).sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("chunk", [10**9, 400, 50, 7])
@pytest.mark.parametrize("same_time", [False, True])
@pytest.mark.parametrize("literals", [20_000, 4])
def test_scans_match_brute_force(spark, chunk, same_time, literals, monkeypatch):
    """Over cut points in the plan, and over ranges that Spark cuts where these would be too many."""
    if literals == 4 and chunk in (10**9, 400):
        pytest.skip("so few chunks are literals")
    monkeypatch.setattr(ordered, "MOST_LITERALS", literals)
    pdf = rows(1200, same_time=same_time)
    got = ordered_scan(spark.createDataFrame(pdf), ["g"], ["t", "id"], scans(), chunk).toPandas().sort_values("id").reset_index(drop=True)
    want = expected(pdf)
    for c in scans():
        pd.testing.assert_series_equal(got[c].astype(float), want[c].astype(float), check_names=False)


def test_busy_group_is_split_and_small_groups_are_not(spark):
    df = spark.createDataFrame(rows(6000))
    splits = plan_splits(df, ["g"], ["t", "id"], 250)
    assert {e[0] for e in splits.edges} >= {"busy"}
    chunks = df.withColumn("_chunk", splits.chunk()).groupBy("g", "_chunk").count().toPandas()
    assert (chunks.g == "busy").sum() > 4
    assert chunks[chunks.g == "busy"]["count"].max() < 1000


def test_scan_without_group(spark):
    df = spark.createDataFrame(rows(3000))
    got = ordered_scan(df, [], ["t", "id"], {"r": Scan("count")}).orderBy("t", "id").toPandas()
    assert list(got.r) == list(range(1, 3001))


def test_null_groups_are_groups(spark):
    pdf = rows(900)
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != "busy", F.col("g")))
    got = ordered_scan(df, ["g"], ["t", "id"], {"n": Scan("count")}, 60).where("g is null").orderBy("t", "id").toPandas()
    assert list(got.n) == list(range(1, 301))


def test_no_group_meets_in_one_task_when_split(spark):
    df = spark.createDataFrame(rows(3000))
    plan = ordered_scan(df, ["g"], ["t", "id"], {"n": Scan("count")}, 100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g#" in plan and "_chunk#" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=5, max_size=60), st.integers(2, 20))
def test_percentiles_match_numpy(spark, values, chunk):
    df = spark.createDataFrame(pd.DataFrame({"g": ["x"] * len(values), "v": values}))
    row = percentiles(df, ["g"], "v", {"a": 0.0, "b": 0.37, "c": 0.5, "d": 0.99, "e": 1.0}, chunk).first()
    want = np.percentile(values, [0, 37, 50, 99, 100])
    assert np.allclose([row.a, row.b, row.c, row.d, row.e], want, rtol=1e-9, atol=1e-9)
    assert row.a <= row.b <= row.c <= row.d <= row.e


def test_percentiles_skip_nulls_and_rank_ties(spark):
    values = [1.0] * 500 + [2.0] * 300 + [9.0] * 200
    df = spark.createDataFrame(pd.DataFrame({"v": values})).unionByName(spark.sql("select cast(null as double) v"))
    row = percentiles(df, [], "v", {"p50": 0.5, "p75": 0.75, "p99": 0.99}, 100).first()
    assert (row.p50, row.p75, row.p99) == tuple(np.percentile(values, [50, 75, 99]))


def test_approximate_percentiles_have_bounded_error(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    row = percentiles(df, [], "v", {"p95": 0.95}, approximate=1000).first()
    assert abs(row.p95 - 95_000) <= 100


KEYS = {
    "timestamp": "timestamp_millis(1700000000000 + t * 137)",
    "timestamp_ntz": "cast(timestamp_millis(1700000000000 + t * 137) AS timestamp_ntz)",
    "date": "date_add(DATE'2024-01-01', cast(t AS int))",
    "decimal": "cast(t / 7.0 AS decimal(20, 6))",
    "binary": "unhex(lpad(hex(t), 8, '0'))",
    "string": "concat('k', lpad(cast(t AS string), 6, '0'))",
    "double": "CASE WHEN t % 10 = 9 THEN double('NaN') WHEN t % 10 = 8 THEN NULL ELSE t / 3.0D END",
}


@pytest.mark.parametrize("kind", KEYS)
def test_keys_of_every_type_are_split(spark, kind):
    """As the order, and as the group."""
    df = spark.createDataFrame(rows(1500)).selectExpr("g", "id", "v", f"{KEYS[kind]} AS k")
    for group, order in ((["g"], ["k", "id"]), (["k"], ["v", "id"]), (["g", "k"], ["id"])):
        one = ordered_scan(df, group, order, {"n": Scan("count"), "s": Scan("sum", F.col("v"))}, 10**9)
        cut = plan_splits(df, group, order, 40)
        assert cut.edges or group != ["g"]
        many = ordered_scan(df, group, order, {"n": Scan("count"), "s": Scan("sum", F.col("v"))}, 40)
        assert {tuple(r) for r in many.select("id", "n", "s").collect()} == {tuple(r) for r in one.select("id", "n", "s").collect()}


def test_many_small_chunks_take_few_tasks(spark, monkeypatch):
    """Chunks beyond the literals are cut inside ranges of many rows: no task and no file for each."""
    monkeypatch.setattr(ordered, "MOST_LITERALS", 4)
    staged = []
    write = ordered.stage
    monkeypatch.setattr(ordered, "stage", lambda df, name: staged.append((name, out := write(df, name))) or out)
    pdf = rows(6_000)
    df = spark.createDataFrame(pdf)
    got = ordered_scan(df, ["g"], ["t", "id"], scans(), rows_per_chunk=5).orderBy("id").toPandas()
    pd.testing.assert_frame_equal(got, expected(pdf)[got.columns], check_dtype=False)
    chunked = dict(staged)["ranged-rows"]
    sizes = [r["count"] for r in chunked.groupBy(ordered.CHUNK).count().collect()]
    assert max(sizes) == 5 and len(sizes) >= 1_200
    assert len(chunked.inputFiles()) < 10

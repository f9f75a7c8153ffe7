"""Split, fit, report, save and load."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardwatch.operators import training as T
from wardwatch.operators.scoring import score_vitals
from wardwatch.plans.pipeline import train
from wardwatch.schemas import FEATURE_ORDER
from wardwatch.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    n = 1500
    x = pd.DataFrame({c: rng.normal(size=n) for c in FEATURE_ORDER})
    z = 0.8 * x["age"] - 1.1 * x["bmi"] + 0.3
    x[T.LABEL] = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    x["event_id"] = range(n)
    return x, spark.createDataFrame(x).cache()


def newton(x, y):
    """Minimum of the log loss plus half the squared weights, the intercept free."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (p - y) + penalty @ w)
        w -= step
    return w


def test_coefficients_match_an_exact_solver(table):
    pdf, df = table
    model = T.as_risk_model(T.train_risk_model(df))
    want = newton(pdf[list(FEATURE_ORDER)].to_numpy(), pdf[T.LABEL].to_numpy())
    got = [model.weights[c] for c in FEATURE_ORDER] + [model.intercept]
    assert np.allclose(got, want, atol=1e-3)


def test_strongest_coefficients_come_first(spark, table):
    model = T.as_risk_model(T.train_risk_model(table[1]))
    rows = T.rank_coefficients(spark, model).collect()
    assert [r.feature for r in rows[:2]] == ["bmi", "age"]
    assert [abs(r.coefficient) for r in rows] == sorted((abs(r.coefficient) for r in rows), reverse=True)


def test_model_survives_saving(spark, table, tmp_path):
    fitted = T.train_risk_model(table[1])
    save_model(spark, fitted, str(tmp_path / "m"), version="2.0")
    loaded = load_model(spark, str(tmp_path / "m"))
    assert loaded.version == "2.0" and loaded.feature_columns == FEATURE_ORDER
    assert loaded.weights == pytest.approx({c: float(v) for c, v in zip(FEATURE_ORDER, fitted.coefficients)})


@pytest.mark.parametrize("digits", [1, 2, 4, 32])
def test_split_keeps_label_shares(table, digits):
    pdf, df = table
    parts = T.stratified_split(df, "event_id", digits=digits).groupBy(T.LABEL).agg(F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n"))
    assert all(r.t == int(np.ceil(0.2 * r.n)) for r in parts.collect())


def test_report_by_hand(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 0)] * 4 + [(0, 1)] * 2, "y INT, p INT")
    rows = {r["class"]: r for r in T.classification_report(df, "y", "p").collect()}
    assert rows["1"].precision == pytest.approx(0.6) and rows["1"].recall == pytest.approx(0.75)
    assert rows["accuracy"].f1 == pytest.approx(0.7) and rows["weighted avg"].support == 10
    assert rows["macro avg"].recall == pytest.approx((0.75 + 4 / 6) / 2)


def test_report_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y INT, p INT")
    row = [r for r in T.classification_report(df, "y", "p").collect() if r["class"] == "1"][0]
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_training_drops_unknown_categories_and_scores(spark, sf_dir, tmp_path):
    from wardwatch.fixtures import vitals

    rows = vitals(spark, sf_dir)
    model, report = train(spark, rows, "event_id", str(tmp_path / "m"))
    assert {r["class"] for r in report.collect()} >= {"0", "1", "accuracy"}
    loaded = load_model(spark, str(tmp_path / "m"))
    a, b = (score_vitals(rows, m).agg(F.sum("risk_score")).first()[0] for m in (model, loaded))
    assert a == pytest.approx(b)


def test_sample_is_the_same_every_time(spark):
    df = spark.range(1000).withColumnRenamed("id", "event_id")
    first, second = ([r.event_id for r in T.sample_rows(df.repartition(n), 50).collect()] for n in (2, 7))
    assert sorted(first) == sorted(second) and len(set(first)) == 50


@pytest.mark.parametrize("n", [0, 1, 50, 999, 1000, 5000])
def test_sample_is_the_first_by_hash(spark, n):
    """Found by counting digits; half the table is filtered, not gathered in one task."""
    import hashlib

    df = spark.range(1000).withColumnRenamed("id", "event_id")
    want = sorted(range(1000), key=lambda i: (hashlib.md5(f"{i}:42".encode()).hexdigest(), i))[:n]
    out = T.sample_rows(df, n)
    assert sorted(r.event_id for r in out.collect()) == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan
    if 0 < n <= 1000:
        found = T.hash_threshold(df, F.md5(F.concat(F.col("event_id").cast("string"), F.lit(":42"))), "event_id", n, digits=1, few=3)
        assert found[1] == want[-1]


def test_report_of_held_out_rows_by_hand(spark, sf_dir):
    """Precision, recall and F1 counted row by row in Python."""
    from wardwatch.catalog import QUERIES

    rows = {r["class"]: r for r in QUERIES["held_out_report"](spark, sf_dir).collect()}
    assert set(rows) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert all(r.recomputed and r.better_than_turned for r in rows.values())
    scored = spark.createDataFrame([(i % 3 % 2, int(i % 5 < 2)) for i in range(200)], "y INT, p INT")
    pairs = [(r.y, r.p) for r in scored.collect()]
    hit, said, was = sum(y == p == 1 for y, p in pairs), sum(p for _, p in pairs), sum(y for y, _ in pairs)
    row = next(r for r in T.classification_report(scored, "y", "p").collect() if r["class"] == "1")
    assert (row.precision, row.recall, row.f1) == pytest.approx((hit / said, hit / was, 2 * hit / (said + was)))

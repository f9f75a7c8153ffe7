import math
import random

import numpy as np
import pytest

from wardwatch.llm import whitening
from wardwatch.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>"


def by_eigenvectors(rows, components=16):
    """Whole-number arithmetic for sums and deviations, and the eigenvectors of the covariance."""
    valid = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in valid})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = []
    for i, x in valid:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        moved = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        for k, at in enumerate(order):
            if values[at] > 1e-9 * values.max():
                out.append((i, k + 1, n, deviation, abs(moved @ vectors[:, at] / math.sqrt(values[at])), values[at] / values.sum()))
    return out


def check(df, rows, components=16):
    got = whitening.whiten(df, components=components).collect()
    want = by_eigenvectors(rows, components)
    key = lambda r: (str(r[0]), r[1], r[3], round(abs(r[4]), 6))
    got_rows = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got], key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got_rows] == [r[:4] for r in want]
    np.testing.assert_allclose([r[4] for r in got_rows], [r[4] for r in want], rtol=1e-6, atol=1e-6)
    np.testing.assert_allclose([r[5] for r in got_rows], [r[5] for r in want], rtol=1e-8)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    return got


def test_given_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = check(df, rows)
    assert {r.component for r in got} == set(range(1, 17))
    assert "op12_embedding_whitening" in QUERIES


def test_odd_rows_and_low_rank(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 2), rng.gauss(1, 0.1), 3.5, 0.0]) for i in range(300)]
    rows = [(i, [*v[:3], v[0]]) for i, v in rows]  # one constant and one repeated dimension: rank 2
    rows += [(5, rows[5][1]), (None, rows[6][1])] + [(1_000 + i, rows[0][1]) for i in range(200)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [1.0, math.nan, 2.0, 3.0]), (904, [1.0, math.inf, 2.0, 3.0])]
    df = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    # The reference keeps floats, as the table does.
    kept = [(r.vec_id, r.embedding) for r in df.collect()]
    got = check(df, kept)
    assert {r.component for r in got} == {1, 2}
    shorter = df.unionByName(spark.createDataFrame([(77, [1.0, 2.0])], SCHEMA))
    assert whitening.whiten(shorter).count() == len(got)
    crowded = df.selectExpr("*", "'a' as x", "'b' as key", "1 as n", "2 as component", "3 as v")
    assert whitening.whiten(crowded).count() == len(got)


def test_spread_of_many_magnitudes(spark):
    rng = np.random.default_rng(3)
    turned, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    x = (rng.normal(size=(400, 6)) * [1e7, 1e5, 1e4, 1e3, 10, 0.5]) @ turned
    df = spark.createDataFrame([(i, [float(c) for c in row]) for i, row in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert {r.component for r in got} == set(range(1, 7)) and got[0].identity_error < 1e-6
    whole = np.floor(64 * x)
    sizes = np.linalg.svd(whole - whole.mean(0), compute_uv=False)
    for r in got[:6]:
        assert r.explained == pytest.approx(sizes[r.component - 1] ** 2 / (sizes**2).sum(), rel=1e-4)


def test_few_rows(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    assert whitening.whiten(one).collect() == [] and whitening.whiten(one.limit(0)).collect() == []
    assert whitening.whiten(one).columns == "vec_id component n deviation whitened explained identity_error".split()
    check(spark.createDataFrame([(1, [1.0, 2.0]), (2, [4.0, 2.0]), (3, [0.0, 0.0])], SCHEMA), [(1, [1.0, 2.0]), (2, [4.0, 2.0]), (3, [0.0, 0.0])])


def test_deviation_is_exact_or_null():
    centre = whitening.Centre(3, [10, 2**55])
    x = np.array([[4, 2**53 - 1], [0, -(2**53) + 1]])
    want = [sum((3 * v - s) ** 2 for v, s in zip(row, [10, 2**55])) for row in x.tolist()]
    assert centre.deviation(x) == [w if w < 2**63 else None for w in want]

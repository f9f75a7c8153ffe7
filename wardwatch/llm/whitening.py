"""Whitening of embeddings by shifted CholeskyQR: Gram matrices of the centred rows are summed over the cluster, their
Cholesky factors orthogonalise the rows by triangular solves, the factors are composed into one R, and the singular
values and vectors of R give the components.

Each entry c becomes the whole number floor(64 * c) + 1000000, so that sums and centres are exact; the fit list holds each
distinct vector once. Rows stay where they are: a Gram pass sends one matrix per task, added up in two steps, and the
driver sees at most `MERGERS` matrices of d x d. The first factors are taken with a shift, which lets the Cholesky
succeed whatever the condition; shifted passes go on until the rows are well conditioned, two plain ones end the work.
Directions in which the rows do not differ (beyond rounding) are left out, so there are as many components as the
fit list has rank, at most `components`.

Defined results: rows whose vector is null, empty, holds a null or non-finite entry, or an entry of 2**47 or more (which
does not fit the whole numbers), take no part, nor do vectors of another length than the most frequent (the shortest
such). Repeated rows and rows without an id give a result each. A table with fewer than two distinct vectors has no component
and gives no rows. `deviation` is null where it does not fit a long. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.session import ship, stage

ship(__name__)

COMPONENTS = 16
#: Fixed by the contract: steps per unit, and what is added.
STEPS, OFFSET = 64, 1_000_000
#: Tasks that add up matrices of the others.
MERGERS = 32
#: Entries below this give whole numbers that doubles hold exactly.
LARGEST = 2.0**47
UNIT = 2.0**-53
#: Rows are well conditioned when the least eigenvalue of their Gram matrix is this share of the largest.
CONDITION = 0.01
#: A direction in which rows spread by less than this share of the largest spread is rounding.
NOTHING = 1e-13
#: Each shifted pass gains some four digits of condition, so few are needed; more mean that something is wrong.
MOST_PASSES = 12
_LIMB = 26


def whole_numbers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`key, x`: the whole numbers of the rows that take part."""
    v = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).where("size(v) > 0")
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    x = v.where(F.forall("v", sound)).select("key", F.transform("v", lambda c: F.floor(c * STEPS) + F.lit(OFFSET)).alias("x"))
    length = x.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n")
    return x.join(F.broadcast(length), F.size("x") == F.col("n"), "left_semi")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def summed(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of `work(rows)` over all rows; None where there are none. Tasks hold one result, the driver `MERGERS`."""

    def add(batches: Iterator[pa.RecordBatch], of: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> pa.RecordBatch | None:
        total = None
        for batch in batches:
            for part in of(batch):
                total = part if total is None else total + part
        if total is None:
            return None
        bucket = TaskContext.get().partitionId() % MERGERS
        names = ["bucket", "kind", "shape", "total"]
        return pa.RecordBatch.from_pydict(dict(zip(names, ([bucket], [total.dtype.str], [list(total.shape)], [total.tobytes()]))), schema)

    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("shape", pa.list_(pa.int64())), ("total", pa.binary())])

    def read(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for row in batch.to_pylist():
            yield np.frombuffer(row["total"], row["kind"]).reshape(row["shape"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = add(batches, lambda batch: iter([work(matrix(batch))] if batch.num_rows else []))
        yield from [] if done is None else [done]

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = add(batches, read)
        yield from [] if done is None else [done]

    spelled = "bucket int, kind string, shape array<bigint>, total binary"
    parts = rows.mapInArrow(first, spelled).repartition(MERGERS, "bucket").mapInArrow(second, spelled)
    totals = [np.frombuffer(r["total"], r["kind"]).reshape(r["shape"]) for r in parts.collect()]
    return sum(totals[1:], totals[0]) if totals else None


class Centre:
    """The exact mean S / n of each dimension, as a whole part and a rest over n."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def moved(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part is taken off exactly."""
        return (x - self.whole) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S) ** 2 of each row, exact; None beyond a long."""
        y = x - self.whole
        most = (float(np.abs(y).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 2.0**62:
            scaled = y * self.n - self.rest
            return (scaled * scaled).sum(1).tolist()
        rest = self.rest.tolist()
        exact = [sum((v * self.n - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist()]
        return [e if e < 2**63 else None for e in exact]


def centre_of(fit: DataFrame) -> Centre | None:
    def work(x: np.ndarray) -> np.ndarray:
        # Two limbs, so that sums of any table fit.
        low = x & ((1 << _LIMB) - 1)
        return np.stack([(x >> _LIMB).sum(0), low.sum(0), np.full(x.shape[1], len(x))])

    total = summed(fit, work)
    if total is None:
        return None
    high, low, n = total.tolist()
    return Centre(n[0], [(h << _LIMB) + l for h, l in zip(high, low)])


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of the upper triangular r, column by column."""
    out = rows.copy()
    for j in range(r.shape[1]):
        out[:, j] = (out[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


#: What has been done to the centred rows: ("solve", R) multiplies by the inverse of R, ("keep", W) by W.
Step = tuple[str, np.ndarray]


def taken(rows: np.ndarray, steps: list[Step]) -> np.ndarray:
    for kind, by in steps:
        rows = solve(rows, by) if kind == "solve" else rows @ by
    return rows


def orthogonalise(gram: Callable[[list[Step]], np.ndarray], n: int) -> np.ndarray:
    """R (rank x d) with centred rows = Q R and orthonormal Q; `gram(steps)` is the Gram matrix of the rows after the steps."""
    steps: list[Step] = []
    r, plain, checked, most = None, 0, False, 0.0
    for number in range(MOST_PASSES):
        g = gram(steps)
        g = (g + g.T) / 2
        d = len(g)
        values, vectors = np.linalg.eigh(g)
        if r is None:
            r, most = np.eye(d), float(np.sqrt(max(values[-1], 0)))
        if most == 0:
            return np.zeros((0, d))
        if number >= 2 and not checked and values[0] < CONDITION * values[-1]:
            # Two shifted passes tell spreads down to rounding apart.
            checked = True
            inverse = np.eye(r.shape[1])
            for kind, by in steps:
                inverse = solve(inverse, by) if kind == "solve" else inverse @ by
            spread = np.sqrt(np.maximum(values, 0)) / np.linalg.norm(inverse @ vectors, axis=0)
            kept = vectors[:, spread > NOTHING * most]
            if kept.shape[1] < d:
                steps.append(("keep", kept))
                r = kept.T @ r
                g = kept.T @ g @ kept
                values, d = np.linalg.eigvalsh(g), kept.shape[1]
                if d == 0:
                    return r
        if number and values[0] >= CONDITION * values[-1]:
            factor, plain = np.linalg.cholesky(g).T, plain + 1
        else:
            shift = min(11 * (n * d + d * (d + 1)) * UNIT, 1e-3) * values[-1]
            factor, plain = np.linalg.cholesky(g + shift * np.eye(d)).T, 0
        steps.append(("solve", factor))
        r = factor @ r
        if plain == 2:
            return r
    raise ArithmeticError(f"rows are not orthogonal after {MOST_PASSES} passes")


class Whitening:
    """Components of a fit list: unit vectors (one a column), their eigenvalues, their shares of the trace."""

    def __init__(self, fit: DataFrame, centre: Centre, components: int = COMPONENTS):
        self.centre = centre

        def gram(steps: list[Step]) -> np.ndarray:
            def work(x: np.ndarray) -> np.ndarray:
                rows = taken(centre.moved(x), steps)
                return rows.T @ rows

            return summed(fit, work)

        r = orthogonalise(gram, centre.n)
        _, sizes, turned = np.linalg.svd(r, full_matrices=False)
        self.values = sizes[:components] ** 2 / centre.n
        self.explained = sizes[:components] ** 2 / max(float((sizes**2).sum()), np.finfo(float).tiny)
        self.projection = turned[:components].T / np.sqrt(self.values)
        self.identity_error = 0.0
        if len(self.values):
            projection = self.projection

            def whitened(x: np.ndarray) -> np.ndarray:
                rows = centre.moved(x) @ projection
                return np.concatenate([rows.T @ rows, rows.sum(0)[None, :]])

            total = summed(fit, whitened) / centre.n
            covariance = total[:-1] - np.outer(total[-1], total[-1])
            self.identity_error = float(np.abs(covariance - np.eye(len(self.values))).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row that takes part and component: `key, component, n, deviation, whitened, explained, identity_error`."""
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, key, vector)
    kind = dict(vectors.dtypes)[key]
    fit = stage(rows.select("x").distinct(), "whitening-fit")
    centre = centre_of(fit)
    model = Whitening(fit, centre, components) if centre else None
    if model is None or not len(model.values):
        fields = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], f"`{key}` {kind}, {fields}")
    projection = model.projection

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch)
            values = centre.moved(x) @ projection
            offsets = np.arange(len(x) + 1, dtype=np.int32) * projection.shape[1]
            whitened = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            arrays = [batch.column("key"), pa.array(centre.deviation(x), pa.int64()), whitened]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "deviation", "whitened"])

    mapped = rows.mapInArrow(run, f"key {kind}, deviation bigint, whitened array<double>")
    shares = F.array(*[F.lit(float(s)) for s in model.explained])
    return mapped.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("key").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )

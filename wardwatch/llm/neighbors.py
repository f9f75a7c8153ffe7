"""Approximate nearest neighbours by inner product, from balanced posting lists.

Centroids are fitted on a bounded sample: halves of equal size, cut again and again, so lists come out
balanced. Every vector is put into the list of its nearest centroid and, where it lies near a border, into
those of the next ones too. Centroids are few enough for one task; they are searched by walking a graph of
neighbours. A query visits the lists whose centroid is not much farther than its nearest; how many, and how
much farther, is found per run: both grow until a sample of the queries, held against brute force over all
rows, finds `RECALL` of its neighbours, if need be up to all lists.

Inner product is turned into distance by one more coordinate that gives all vectors the largest norm; the
scores are inner products of the vectors as they are, added up in double precision from first to last.

Lists that are too long, such as one with a third of all rows equal, are dealt out by id into chunks, and
so are the queries that visit a list; each pair of chunks is one small group. Nothing grows with the table
but the rows: the driver sees the sample and a count for each list.

Defined results: vectors that are null, zero, or hold a null or non-finite component, and rows without id,
take no part, nor do vectors of another length than the most frequent (the shortest such). Rows of one id
are one candidate with its best score. Equal scores rank by smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardwatch.llm.common import map_arrow
from wardwatch.session import ship, stage

ship(__name__)

K = 20
#: Vectors in the sample that centroids are fitted on, vectors per list that are aimed at, and most lists.
SAMPLE, LIST_ROWS, MOST_LISTS = 65_536, 200, 4_096
#: A vector goes to at most so many lists, those within this ratio of the nearest centroid's distance.
REPLICAS, NEAR = 4, 1.1
#: A query visits so many lists, those within this ratio, and at least lists with so many rows; the first two
#: are where calibration begins.
PROBES, REACH, LEAST_ROWS = 64, 1.35, 1_000
#: Queries that calibration holds against brute force, the recall they have to reach, and the steps to it.
HELD, RECALL, MORE_PROBES, MORE_REACH = 256, 0.95, 1.25, 1.05
#: Neighbours of a centroid in the graph.
DEGREE = 24
#: Rows of a list, and queries of a list, in one group.
CHUNK = 4_000


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id, v` (array of double) of the rows that take part."""
    x = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    x = x.where(F.forall("v", finite) & F.exists("v", lambda c: c != 0))
    length = x.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n")
    return x.join(F.broadcast(length), F.size("v") == F.col("n"), "left_semi")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """One more coordinate, so that every row has the norm `most`."""
    return np.c_[x, np.sqrt(np.maximum(0, most * most - (x * x).sum(1)))]


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """Means of `lists` parts of equal size, found by halving along the line between two means."""
    parts = [np.arange(len(x))]
    while len(parts) < lists:
        largest = max(range(len(parts)), key=lambda i: len(parts[i]))
        own = parts.pop(largest)
        if len(own) < 2:
            parts.append(own)
            break
        rows = x[own]
        axis = rows[len(own) // 2] - rows[0]
        for _ in range(8):
            side = rows @ axis
            high = side > np.median(side)
            if not high.any() or high.all():
                break
            axis = rows[high].mean(0) - rows[~high].mean(0)
        order = np.argsort(rows @ axis, kind="stable")
        parts += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return np.unique(np.array([x[p].mean(0) for p in parts]), axis=0)


def neighbour_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """For each centroid its nearest others, the last ones spread over the whole range so that no part is cut off."""
    n = len(centroids)
    links = np.empty((n, min(degree, n)), np.int64)
    squares = (centroids * centroids).sum(1)
    for at in range(0, n, 512):
        some = centroids[at : at + 512]
        distance = squares[None, :] - 2 * some @ centroids.T
        links[at : at + 512] = np.argsort(distance, axis=1, kind="stable")[:, : links.shape[1]]
    far = max(1, links.shape[1] // 6)
    links[:, -far:] = (np.arange(n)[:, None] + n * (1 + np.arange(far)) // (far + 1)) % n
    return links


def walk(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the `width` nearest centroids that a walk finds, nearest first, and their squared distances.

    All rows walk at once: each opens its nearest centroid that it has not opened yet, until none is left.
    """
    n, width = len(x), min(width, len(centroids))
    squares, rows = (centroids * centroids).sum(1), np.arange(n)
    own = (x * x).sum(1)
    step = max(1, len(centroids) // width)
    best = np.broadcast_to((np.arange(width) * step)[None, :], (n, width)).copy()
    apart = own[:, None] + squares[best] - 2 * x @ centroids[best[0]].T if n else np.empty((0, width))
    seen = np.zeros((n, len(centroids)), bool)
    seen[:, best[0] if n else []] = True
    opened = np.zeros((n, len(centroids)), bool)
    live = rows
    while len(live):
        closed = opened[live[:, None], best[live]]
        first = np.where(closed, np.inf, apart[live]).argmin(1)
        some = ~closed[np.arange(len(live)), first]
        live, first = live[some], first[some]
        if not len(live):
            break
        node = best[live, first]
        opened[live, node] = True
        near = graph[node]
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        distance = own[live, None] + squares[near] - 2 * np.einsum("ij,ikj->ik", x[live], centroids[near])
        nodes = np.c_[best[live], near]
        lengths = np.c_[apart[live], np.where(fresh, distance, np.inf)]
        order = np.argsort(lengths, axis=1, kind="stable")[:, :width]
        best[live], apart[live] = np.take_along_axis(nodes, order, 1), np.take_along_axis(lengths, order, 1)
    order = np.argsort(apart, axis=1, kind="stable")
    return np.take_along_axis(best, order, 1), np.maximum(0, np.take_along_axis(apart, order, 1))


def nearest_lists(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """As `walk`; where a walk would look at all centroids anyway, they are compared at once."""
    width = min(width, len(centroids))
    if width * graph.shape[1] < len(centroids):
        return walk(x, centroids, graph, width)
    squared = np.maximum(0, (x * x).sum(1)[:, None] + (centroids * centroids).sum(1)[None, :] - 2 * x @ centroids.T)
    order = np.argsort(squared, axis=1, kind="stable")[:, :width]
    return order, np.take_along_axis(squared, order, 1)


def visited(v: np.ndarray, most: float, centroids: np.ndarray, graph: np.ndarray, rows_of: np.ndarray, probes: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nearest lists, and which of them it visits."""
    v = v * (most / np.sqrt((v * v).sum(1)))[:, None]
    found, squared = nearest_lists(np.c_[v, np.zeros(len(v))], centroids, graph, probes)
    before = np.cumsum(rows_of[found], axis=1) - rows_of[found]
    return found, (squared <= reach * reach * np.maximum(squared[:, :1], 1e-300)) | (before < LEAST_ROWS)


def true_neighbours(x: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """`number, vec_id`: the k best others of each of a few queries (`ids`, rows of `q`), from all rows of x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, score = np.zeros((len(q), 0), np.int64), np.empty((len(q), 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                part = batch.slice(at, 5_000)
                own = part["vec_id"].to_numpy()
                order = np.argsort(own, kind="stable")
                first = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]])
                new = np.maximum.reduceat((q @ _matrix(part["v"]).T)[:, order], first, axis=1)
                new[ids[:, None] == own[order][first][None, :]] = -np.inf
                top = np.argsort(-new, axis=1, kind="stable")[:, :k]
                best, score = np.c_[best, own[order][first][top]], np.c_[score, np.take_along_axis(new, top, 1)]
                # An id met before counts once, with its best score.
                order = np.lexsort((-score, best), axis=1)
                best, score = np.take_along_axis(best, order, 1), np.take_along_axis(score, order, 1)
                score[:, 1:][best[:, 1:] == best[:, :-1]] = -np.inf
                order = np.argsort(-score, axis=1, kind="stable")[:, :k]
                best, score = np.take_along_axis(best, order, 1), np.take_along_axis(score, order, 1)
        number, _ = np.nonzero(score > -np.inf)
        good = score > -np.inf
        yield pa.record_batch([pa.array(number), pa.array(best[good]), pa.array(score[good])], ["number", "vec_id", "score"])

    once = map_arrow(x, run, "number bigint, vec_id bigint, score double").groupBy("number", "vec_id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("number", "vec_id")


def calibrated(wanted: pa.Table, held_out: np.ndarray, most: float, centroids: np.ndarray, graph: np.ndarray, rows_of: np.ndarray) -> tuple[int, float]:
    """Probes and reach with which queries find `RECALL` of their neighbours; `wanted` says in which lists these are."""
    number, of, lists = (wanted[c].to_numpy() for c in ("number", "vec_id", "list"))
    pair = np.unique(np.stack([number, of]), axis=1, return_inverse=True)[1].reshape(-1)
    probes, reach = min(PROBES, len(centroids)), REACH
    while len(pair):
        found, keep = visited(held_out, most, centroids, graph, rows_of, probes, reach)
        open_lists = np.zeros((len(held_out), len(centroids)), bool)
        row, _ = np.nonzero(keep)
        open_lists[row, found[keep]] = True
        hit = np.bincount(pair, open_lists[number, lists]) > 0
        if hit.mean() >= RECALL or open_lists.all():
            break
        probes, reach = min(len(centroids), int(np.ceil(probes * MORE_PROBES))), reach * MORE_REACH
    return probes, reach


def _chunks(sizes: DataFrame, n: str) -> Column:
    return F.ceil(F.col(n) / CHUNK).cast("int")


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """`query_id, rank, vec_id, score`: for rows of `vectors` (`vec_id, embedding`) with `is_query`, the k nearest others found."""
    x = stage(usable(vectors), "neighbours-vectors")
    empty = vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    n, most = x.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))).first()
    if not n:
        return empty
    most = float(most) ** 0.5
    sample = x.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    lists = int(min(MOST_LISTS, max(1, n // LIST_ROWS)))
    centroids = balanced_centroids(lifted(_matrix(sample["v"]), most), lists)
    graph = neighbour_graph(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                found, squared = walk(lifted(_matrix(part["v"]), most), centroids, graph, 4 * REPLICAS)
                keep = squared <= NEAR * NEAR * squared[:, :1]
                keep[:, REPLICAS:] = False
                row, _ = np.nonzero(keep)
                yield pa.record_batch([pa.array(found[keep]), part["vec_id"].take(pa.array(row)), part["v"].take(pa.array(row))], ["list", "vec_id", "v"])

    kind = x.schema["vec_id"].dataType.simpleString()
    posted = stage(map_arrow(x, place, f"list bigint, vec_id {kind}, v array<double>"), "neighbours-lists")
    sizes = posted.groupBy("list").agg(F.count("*").alias("rows"))
    rows_of = np.zeros(len(centroids), np.int64)
    for number, rows in sizes.collect():  # one row per list, at most MOST_LISTS
        rows_of[number] = rows

    queries = x.where(is_query).distinct()
    sampled = queries.orderBy(F.xxhash64("vec_id", F.lit("calibration")), "vec_id", "v").limit(HELD).select("vec_id", "v").toArrow()
    probes, reach = PROBES, REACH
    if len(sampled):
        held_out = _matrix(sampled["v"])
        truth = true_neighbours(x, sampled["vec_id"].to_numpy(), held_out, k)
        # At most k rows per sampled query and list of the neighbour.
        wanted = posted.join(F.broadcast(truth), "vec_id").select("number", "vec_id", "list").distinct().toArrow()
        probes, reach = calibrated(wanted, held_out, most, centroids, graph, rows_of)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                found, keep = visited(_matrix(part["v"]), most, centroids, graph, rows_of, probes, reach)
                row, _ = np.nonzero(keep)
                yield pa.record_batch([pa.array(found[keep]), part["vec_id"].take(pa.array(row)), part["v"].take(pa.array(row))], ["list", "query_id", "v"])

    visits = stage(map_arrow(queries, visit, f"list bigint, query_id {kind}, v array<double>"), "neighbours-visits")
    asked = visits.groupBy("list").agg(F.count("*").alias("asks"))
    # One row per list, at most MOST_LISTS.
    plan = F.broadcast(sizes.join(asked, "list").select("list", _chunks(sizes, "rows").alias("row_chunks"), _chunks(asked, "asks").alias("ask_chunks")))
    row_side = posted.join(plan, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("row_chunks")).cast("int").alias("rc"),
        F.explode(F.sequence(F.lit(0), F.col("ask_chunks") - 1)).alias("ac"), "vec_id", "v",
    )
    ask_side = visits.join(plan, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("row_chunks") - 1)).alias("rc"),
        F.pmod(F.xxhash64("query_id"), F.col("ask_chunks")).cast("int").alias("ac"), "query_id", "v",
    )

    def compare(asks: pa.Table, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
        ids, x = rows["vec_id"].to_numpy()[order], _matrix(rows["v"])[order]
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ids = ids[first]
        out: list[tuple[np.ndarray, ...]] = []
        asked_ids, q = asks["query_id"].to_numpy(), _matrix(asks["v"])
        for at in range(0, len(q), 200):
            some, own = q[at : at + 200], asked_ids[at : at + 200]
            score = np.zeros((len(some), len(x)))
            for d in range(x.shape[1]):
                score += some[:, d, None] * x[None, :, d]
            score = np.maximum.reduceat(score, first, axis=1)
            score[own[:, None] == ids[None, :]] = -np.inf
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            value = np.take_along_axis(score, top, 1)
            good = value > -np.inf
            out.append((np.broadcast_to(own[:, None], top.shape)[good], ids[top][good], value[good]))
        return pa.table([np.concatenate(c) for c in zip(*out)], ["query_id", "vec_id", "score"])

    def compare_groups(asks: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(asks) or not len(rows):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["query_id", "vec_id", "score"])
        return compare(asks, rows)

    key = ["list", "rc", "ac"]
    found = ask_side.groupBy(*key).cogroup(row_side.groupBy(*key)).applyInArrow(compare_groups, "query_id bigint, vec_id bigint, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

"""Service metrics over request records: percentiles, rates, histograms, counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwatch.functions.timing import cell_end
from wardwatch.operators.ordered import ROWS_PER_CHUNK, Scan, ordered_scan
from wardwatch.operators.quantiles import merge_sketches, percentile_columns, percentiles, quantile_sketches, sketch_percentiles
from wardwatch.session import stage

# Bucket edges of the latency histogram in milliseconds, the p99 target, report sizes.
LATENCY_BUCKETS = (1, 2, 5, 10, 20, 30, 50, 100, 200, 500, 1000)
P99_TARGET_MS = 30
PERCENTILE_POINTS = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
BUFFER_ROWS = 1000
RATE_RANGE_MS = 300_000
ERRORS_KEPT = 100

INFINITY = "+Inf"
SKETCH_STEP_MS = 60_000


def non_empty_latency(df: DataFrame) -> DataFrame:
    return df.where(F.col("latency_ms") > 0)


def latency_sketches(df: DataFrame, by: Sequence[str] = ("source",), step_ms: int = SKETCH_STEP_MS) -> DataFrame:
    """A sketch of successful latencies per step (its begin in `step_ms`) and labels, to be stored as a table."""
    good = df.where(F.col("status") == "success").withColumn("step_ms", (F.floor(F.col("ms") / step_ms) * step_ms).cast("bigint"))
    return quantile_sketches(good, ["step_ms", *by], "latency_ms")


def latency_between(
    sketches: DataFrame, by: Sequence[str] = ("source",), from_ms: int | None = None, to_ms: int | None = None, points: Mapping[str, float] = PERCENTILE_POINTS
) -> DataFrame:
    """Percentiles of the steps from `from_ms` to before `to_ms`, from stored sketches alone."""
    if from_ms is not None:
        sketches = sketches.where(F.col("step_ms") >= from_ms)
    if to_ms is not None:
        sketches = sketches.where(F.col("step_ms") < to_ms)
    return sketch_percentiles(merge_sketches(sketches, by), by, points)


def latency_summary(
    df: DataFrame, by: Sequence[str] = (), digits: int | None = None, approximate: int | None = None, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Percentiles, mean, extremes and error share of requests; latencies count for successes only.

    Without a success all latencies are 0.
    """
    ok = F.col("status") == "success"
    latency = F.when(ok, F.col("latency_ms"))
    measures = [
        F.avg(latency).alias("avg_latency_ms"),
        F.min(latency).alias("min_latency_ms"),
        F.max(latency).alias("max_latency_ms"),
        F.count_if(~ok).alias("error_count"),
        F.count_if(ok).alias("successful_requests"),
        F.count(F.lit(1)).alias("total_requests"),
    ]
    if approximate or df.where(ok).count() <= rows_per_chunk:
        joined = df.groupBy(*by).agg(*measures, *percentile_columns(latency, PERCENTILE_POINTS, approximate))
    else:
        points = percentiles(df.where(ok), by, "latency_ms", PERCENTILE_POINTS, rows_per_chunk)
        base = df.groupBy(*by).agg(*measures)
        joined = base.join(points, list(by), "left") if by else base.join(F.broadcast(points), F.lit(True), "left")
    latencies = [*PERCENTILE_POINTS, "avg_latency_ms", "min_latency_ms", "max_latency_ms"]
    share = F.coalesce(F.try_divide(F.col("error_count").cast("double"), F.col("total_requests")), F.lit(0.0))

    def shown(column: Column, places: int) -> Column:
        return F.round(column, places) if digits is not None else column

    return joined.select(
        *by,
        *[shown(F.coalesce(F.col(c), F.lit(0.0)), digits or 2).alias(c) for c in latencies],
        shown(share, 4).alias("error_rate"),
        "error_count",
        "successful_requests",
        "total_requests",
    )


def slo_check(summary: DataFrame, target_ms: float = P99_TARGET_MS) -> DataFrame:
    return summary.withColumn("passed", F.col("p99_ms") < target_ms)


def error_rate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    failed = (F.col("status") != "success").cast("double")
    return df.groupBy(*by).agg(F.coalesce(F.avg(failed), F.lit(0.0)).alias("error_rate"))


def error_breakdown(df: DataFrame) -> DataFrame:
    bad = df.where(F.col("status") != "success")
    return bad.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.avg("latency_ms").alias("avg_latency_ms"))


def labelled_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


def first_errors(df: DataFrame, n: int = ERRORS_KEPT) -> DataFrame:
    """The first `n` failed requests; each task keeps at most `n` rows."""
    return df.where(F.col("status") != "success").orderBy("ms", "event_id").limit(n)


def last_gauge(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias(value))


def sum_series(df: DataFrame, over: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*over).agg(F.sum(value).alias(value))


def _bucket_columns(value: Column, buckets: Sequence[float]) -> list[Column]:
    return [F.count_if(value <= b).alias(f"le_{b}") for b in buckets]


def _as_buckets(wide: DataFrame, keys: Sequence[str], buckets: Sequence[float]) -> DataFrame:
    """Bucket columns as rows `(keys, le, cum)`; the null edge stands for infinity."""
    edges = F.array(
        *[F.struct(F.lit(float(b)).alias("le"), F.col(f"le_{b}").cast("double").alias("cum")) for b in buckets],
        F.struct(F.lit(None).cast("double").alias("le"), F.col("count").cast("double").alias("cum")),
    )
    return wide.select(*keys, F.explode(edges).alias("_b")).select(*keys, "_b.le", "_b.cum")


def latency_histogram(df: DataFrame, by: Sequence[str] = (), buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative bucket counts with sum and count; all buckets are counted in one aggregation."""
    wide = df.groupBy(*by).agg(*_bucket_columns(F.col("latency_ms"), buckets), F.sum("latency_ms").alias("sum"), F.count("latency_ms").alias("count"))
    edges = [F.struct(F.lit(str(b)).alias("le"), F.col(f"le_{b}").alias("cum")) for b in buckets]
    edges.append(F.struct(F.lit(INFINITY).alias("le"), F.col("count").alias("cum")))
    return wide.select(*by, F.explode(F.array(*edges)).alias("_b"), "sum", "count").select(*by, "_b.le", "_b.cum", "sum", "count")


def histogram_quantile(buckets: DataFrame, keys: Sequence[str], q: float, alias: str = "quantile") -> DataFrame:
    """Quantile from cumulative buckets `(keys, le, cum)`, linear inside the bucket it falls in.

    `le` null is the infinite bucket; a quantile in it gives the last finite edge. A series
    without observations has no quantile. A group has as many rows as there are buckets.
    """
    return histogram_quantiles(buckets, keys, {alias: q})


def histogram_quantiles(buckets: DataFrame, keys: Sequence[str], points: Mapping[str, float]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("le").asc_nulls_last())
    ranked = buckets.withColumns(
        {
            "_lower": F.coalesce(F.lag("le").over(order), F.lit(0.0)),
            "_below": F.coalesce(F.lag("cum").over(order), F.lit(0.0)),
            "_total": F.max("cum").over(Window.partitionBy(*keys)),
        }
    ).where(F.col("_total") > 0)
    out = []
    for name, q in points.items():
        rank = F.lit(q) * F.col("_total")
        inside = F.coalesce(F.try_divide(rank - F.col("_below"), F.col("cum") - F.col("_below")), F.lit(0.0))
        value = F.when(F.col("le").isNull(), F.col("_lower")).otherwise(F.col("_lower") + (F.col("le") - F.col("_lower")) * inside)
        place = F.coalesce(F.col("le"), F.lit(float("inf")))
        out.append(F.min_by(value, F.when(F.col("cum") >= rank, place)).alias(name))
    return ranked.groupBy(*keys).agg(*out)


def trailing_sums(steps: DataFrame, by: Sequence[str], values: Sequence[str], step_ms: int, range_ms: int) -> DataFrame:
    """Sums over the trailing range, for `(by, t_ms, values)` with one row per step.

    Each row is handed to the steps that it reaches, and to the one after these with nothing, so a series
    falls to 0 when its traffic stops. What is summed is range / step rows for each, wherever they lie; no
    task holds a series.
    """
    reached = F.explode(F.sequence(F.lit(0), F.lit(range_ms), F.lit(step_ms))).alias("_after")
    spread = steps.select(*by, F.col("t_ms").alias("_from"), *values, reached)
    sums = [F.sum(F.when(F.col("_after") < range_ms, F.col(v)).otherwise(F.lit(0))).alias(v) for v in values]
    return spread.groupBy(*by, (F.col("_from") + F.col("_after")).alias("t_ms")).agg(*sums)


def bucket_rates(
    df: DataFrame, by: Sequence[str] = (), step_ms: int = 60_000, range_ms: int = RATE_RANGE_MS, buckets: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Per-second rate of each latency bucket over the trailing range, at every step that a request reaches.

    Requests are counted per step first, so the trailing sum runs over at most one row per series
    and step.
    """
    at = cell_end(F.col("ms"), step_ms).alias("t_ms")
    steps = df.groupBy(*by, at).agg(*_bucket_columns(F.col("latency_ms"), buckets), F.count("latency_ms").alias("count"))
    names = [f"le_{b}" for b in buckets] + ["count"]
    sums = trailing_sums(steps, by, names, step_ms, range_ms)
    rates = sums.select(*by, "t_ms", *[(F.col(c) / (range_ms / 1000.0)).alias(c) for c in names])
    return _as_buckets(rates, [*by, "t_ms"], buckets)


def counter_rate(counter: DataFrame, by: Sequence[str], range_ms: int = RATE_RANGE_MS, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Per-second increase of a counter over `(t - range, t]`, for samples `(by, ms, value)`.

    A series has one sample per `ms`. A drop is a reset and counts the new value. The increase is a difference of two
    running increases: that of the samples up to `t`, and that of the samples which have left the range by `t`. Each
    sample stands in the series twice, where it comes and where it leaves, so one ordered scan gives both.
    """
    slim = counter.select(*by, "ms", F.col("value").cast("double").alias("value"))
    sides = F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("ms").alias("at")), F.struct(F.lit(0).alias("side"), (F.col("ms") + range_ms).alias("at"))))
    both = slim.select(*by, "value", sides.alias("_s")).select(*by, "value", F.col("_s.at").alias("ms"), F.col("_s.side").alias("_side"))
    scans = {f"_{n}": Scan("increase", F.when(F.col("_side") == side, F.col("value"))) for n, side in (("total", 1), ("gone", 0))}
    scanned = ordered_scan(both, by, ["ms", "_side"], scans, rows_per_chunk).where(F.col("_side") == 1)
    return scanned.select(*by, "ms", ((F.col("_total") - F.col("_gone")) / (range_ms / 1000.0)).alias("rate"))


def count_rate(df: DataFrame, by: Sequence[str], step_ms: int = 60_000, range_ms: int = RATE_RANGE_MS) -> DataFrame:
    """Rows per second over the trailing range, at every step that a row reaches, down to 0 after the last."""
    steps = df.groupBy(*by, cell_end(F.col("ms"), step_ms).alias("t_ms")).agg(F.count(F.lit(1)).alias("n"))
    return trailing_sums(steps, by, ["n"], step_ms, range_ms).select(*by, "t_ms", (F.col("n") / (range_ms / 1000.0)).alias("rate"))


def rolling_percentiles(
    df: DataFrame,
    by: Sequence[str],
    every: int,
    size: int = BUFFER_ROWS,
    points: Mapping[str, float] = PERCENTILE_POINTS,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Percentiles of the last `size` latencies of a series, reported after every `every` requests and at its end.

    Requests are numbered by an ordered scan, then each goes to the few reports that cover it, so
    a report gathers at most `size` rows. The report at the end covers the last `size` rows there are.
    """
    positive = non_empty_latency(df).select(*by, "ms", "event_id", "latency_ms")
    numbered = ordered_scan(positive, by, ["ms", "event_id"], {"_no": Scan("count")}, rows_per_chunk)
    numbered = stage(numbered, "numbered-requests")
    ends = numbered.groupBy(*by).agg(F.max("_no").alias("_end"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    ends = ends.withColumnsRenamed({c: f"_key_{c}" for c in by})
    tail = numbered.join(ends, on).where((F.col("_end") % every != 0) & (F.col("_no") > F.col("_end") - size))
    tail = tail.select(*numbered.columns, (F.floor(F.col("_end") / every) + 1).cast("bigint").alias("report"))
    first = F.ceil(F.col("_no") / every).cast("bigint")
    last = F.floor((F.col("_no") + size - 1) / every).cast("bigint")
    reports = numbered.where(first <= last).withColumn("report", F.explode(F.sequence(first, last)))
    # Reports past the end of the series, other than the last one, were never made.
    full = reports.join(ends, on).where(F.col("report") * every <= F.col("_end")).select(*numbered.columns, "report")
    return full.unionByName(tail).groupBy(*by, "report").agg(
        *[F.percentile("latency_ms", F.lit(q)).alias(name) for name, q in points.items()],
        F.avg("latency_ms").alias("avg_latency_ms"),
    )

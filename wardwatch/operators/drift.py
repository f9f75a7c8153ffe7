"""Data drift between a reference set and current data.

Every measure is built from counts that are aggregated before they are shuffled. Numeric
distributions are compared over their merged distinct values, or over bins where values are too
many to compare one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.functions.scores import relative_change
from wardwatch.operators.lateness import late_flag
from wardwatch.operators.ordered import ROWS_PER_CHUNK, Scan, ordered_scan
from wardwatch.operators.quantiles import percentiles
from wardwatch.session import ship, stage

ship(__name__)

# Drift limits, floors, and the count windows of the drift watcher.
MEAN_SHIFT_LIMIT = 0.2
COLUMN_DRIFT_LIMIT = 0.1
DATASET_DRIFT_LIMIT = 0.2
P_VALUE_LIMIT = 0.05
STD_FLOOR = 0.001
SHARE_FLOOR = 1e-4
WINDOW_ROWS, WINDOW_CARRY, WINDOW_MIN_ROWS = 1000, 100, 100
WATCH_TIMER_MS = 60_000

NEVER_COMPARED = ("patient_id",)

# Numbers are compared over so many bins of the reference range unless every value is to be told apart.
BINS = 200


def known(column: Column | str) -> Column:
    """A number, null where it is not a number: a NaN is a missing value."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(value.cast("double")), value)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = NEVER_COMPARED) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def common_columns(reference: DataFrame, current: DataFrame, exclude: Sequence[str] = NEVER_COMPARED) -> list[str]:
    """Columns that are numeric in the reference and present in the current data."""
    return [c for c in numeric_columns(reference, exclude) if c in current.columns]


def column_means(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean of every column in one pass, as rows `(column, mean)`."""
    columns = list(columns or numeric_columns(df))
    wide = df.agg(*[F.avg(known(c)).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "mean")


def pair_stats(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Match two statistics tables by column name; both have one row per compared column."""
    left = reference.select("column", F.col("mean").alias("ref_mean"))
    right = current.select("column", F.col("mean").alias("cur_mean"))
    return left.join(F.broadcast(right), "column")


def nonzero_guard(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("ref_mean") != 0)


def column_shifts(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Relative change of each column's mean, capped at 1."""
    columns = list(columns or common_columns(reference, current))
    pairs = nonzero_guard(pair_stats(column_means(reference, columns), column_means(current, columns)))
    return pairs.withColumn("shift", relative_change(F.col("ref_mean"), F.col("cur_mean")))


def _verdict(score: Column, limit: float) -> list[Column]:
    score = F.coalesce(score, F.lit(0.0))
    return [score.alias("drift_score"), (score > limit).alias("drift_detected")]


def mean_shift_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Average shift over the columns; detected above 0.2; 0 where nothing can be compared."""
    return column_shifts(reference, current, columns).agg(*_verdict(F.avg("shift"), MEAN_SHIFT_LIMIT))


def min_rows(groups: DataFrame, n: int = WINDOW_MIN_ROWS) -> DataFrame:
    """Groups with enough rows to say anything."""
    return groups.where(F.col("n_rows") >= n)


def shift_by_window(windows: DataFrame, keys: Sequence[str], reference: DataFrame, columns: Sequence[str], at_least: int = WINDOW_MIN_ROWS) -> DataFrame:
    """Mean-shift score of each group of `windows`; groups below `at_least` rows give no row.

    `windows` are the raw rows. Their means are taken in one aggregation, and the reference means,
    one row, are joined as constants.
    """
    means = windows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.avg(known(c)).alias(c) for c in columns])
    return score_window_means(min_rows(means, at_least), keys, reference, columns)


def reference_means(reference: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The reference means as numbers for the plan: one row, whatever the size of the reference."""
    return reference.agg(*[F.avg(known(c)).alias(c) for c in columns]).first().asDict()


def score_window_means(means: DataFrame, keys: Sequence[str], reference: DataFrame | dict, columns: Sequence[str]) -> DataFrame:
    before = reference if isinstance(reference, dict) else reference_means(reference, columns)
    shifts = [relative_change(F.lit(float(before[c])), F.col(c)) for c in columns if before.get(c)]
    total = sum((F.coalesce(s, F.lit(0.0)) for s in shifts), F.lit(0.0))
    counted = sum((s.isNotNull().cast("int") for s in shifts), F.lit(0))
    return means.select(*keys, "n_rows", *_verdict(F.try_divide(total, counted), MEAN_SHIFT_LIMIT))


def count_windows(df: DataFrame, size: int = WINDOW_ROWS, carry: int = WINDOW_CARRY, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Put each row into the count windows that cover it, in order of arrival.

    A window fires at `size` rows and hands its last `carry` rows to the next one, so windows start
    every `size - carry` rows and a row lies in at most a few of them.
    """
    step = size - carry
    numbered = ordered_scan(df, [], ["arrival_ms", "event_id"], {"row_no": Scan("count")}, rows_per_chunk)
    r = F.col("row_no")
    first = F.greatest(F.ceil((r - size) / step), F.lit(0)).cast("bigint")
    last = F.floor((r - 1) / step).cast("bigint")
    return numbered.withColumn("window_no", F.explode(F.sequence(first, last)))


def drift_watch(
    df: DataFrame,
    reference: DataFrame | dict,
    columns: Sequence[str],
    timer_ms: int = WATCH_TIMER_MS,
    size: int = WINDOW_ROWS,
    carry: int = WINDOW_CARRY,
    at_least: int = WINDOW_MIN_ROWS,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """What a watcher finds that checks after `size` rows or when its timer runs out, whichever comes first.

    Rows come in order of arrival and the timer runs out at every multiple of `timer_ms`. A check sees the
    rows since the one before and the last `carry` rows before these, and says nothing below `at_least`
    rows; the last rows are checked too. Beside the drift it gives the share of late rows so far.

    Nothing is gathered by check: sums over a run of rows are differences of two running sums.
    """
    scans = {"row_no": Scan("count"), "late_data_count": Scan("sum", late_flag().cast("bigint"))}
    for c in columns:
        scans |= {f"_sum_{c}": Scan("sum", F.coalesce(known(F.col(c).cast("double")), F.lit(0.0))), f"_n_{c}": Scan("sum", known(c).isNotNull().cast("bigint"))}
    rows = df.select("arrival_ms", "event_ms", "event_id", *[c for c in columns if c not in ("arrival_ms", "event_ms", "event_id")])
    sums = stage(ordered_scan(rows, [], ["arrival_ms", "event_id"], scans, rows_per_chunk), "drift-watch")
    cells = sums.select("row_no", "arrival_ms", F.floor(F.col("arrival_ms") / timer_ms).alias("_cell"))
    begun = cells.groupBy("_cell").agg(F.min("row_no").alias("_first"))
    part = F.floor((F.col("row_no") - F.col("_first")) / (size - carry))
    checks = cells.join(begun, "_cell").groupBy("_cell", part.alias("_part")).agg(F.min("row_no").alias("_from"), F.max("row_no").alias("row_no"))
    checks = checks.withColumn("_out", F.greatest(F.col("_from") - 1 - carry, F.lit(0))).withColumn("n_rows", F.col("row_no") - F.col("_out"))
    names = [n for c in columns for n in (f"_sum_{c}", f"_n_{c}")]
    before = sums.select(F.col("row_no").alias("_out"), *[F.col(n).alias(f"{n}_out") for n in names])
    joined = min_rows(checks, at_least).join(sums, "row_no").join(before, "_out", "left")

    def inside(name: str) -> Column:
        return F.col(name) - F.coalesce(F.col(f"{name}_out"), F.lit(0))

    means = [F.try_divide(inside(f"_sum_{c}"), inside(f"_n_{c}")).alias(c) for c in columns]
    ratio = F.col("late_data_count") / F.col("row_no")
    seen = joined.select("row_no", F.col("arrival_ms").alias("t_ms"), "n_rows", "late_data_count", ratio.alias("late_data_ratio"), *means)
    return score_window_means(seen, ["row_no", "t_ms", "late_data_count", "late_data_ratio"], reference, columns)


def bin_middles(bounds: Mapping[str, tuple[float | None, float | None]], bins: int) -> Column:
    """The middle of the bin of `value` within the bounds of its `column`; the value itself where they hold no range."""
    binned = F.col("value")
    for c, (lo, hi) in bounds.items():
        if lo is None or hi <= lo:
            continue
        width = (hi - lo) / bins
        place = F.least(F.greatest(F.floor((F.col("value") - lo) / width), F.lit(0)), F.lit(bins - 1))
        binned = F.when(F.col("column") == c, lo + (place + 0.5) * width).otherwise(binned)
    return binned


def value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int | None = None) -> DataFrame:
    """Rows `(column, value, ref_n, cur_n)` over the merged values of numeric columns; nulls and NaNs are skipped.

    With `bins` a value counts as the middle of its bin; bins divide the reference range evenly
    and the outer two are open.
    """
    sides = []
    for side, frame in (("ref_n", reference), ("cur_n", current)):
        doubles = frame.select(*[known(F.col(c).cast("double")).alias(c) for c in columns])
        sides.append(doubles.unpivot([], list(columns), "column", "value").withColumn("_side", F.lit(side)))
    rows = sides[0].unionByName(sides[1]).where(F.col("value").isNotNull())
    if bins:
        bounds = reference.agg(*[f(known(c)).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
        rows = rows.withColumn("value", bin_middles({c: (bounds[f"lo_{c}"], bounds[f"hi_{c}"]) for c in columns}, bins))
    return rows.groupBy("column", "value").agg(
        F.count_if(F.col("_side") == "ref_n").alias("ref_n"),
        F.count_if(F.col("_side") == "cur_n").alias("cur_n"),
    )


def _cumulative(counts: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Cumulative shares before and at each value, and the value before it."""
    scans = {
        "_ref_cum": Scan("sum", F.col("ref_n")),
        "_cur_cum": Scan("sum", F.col("cur_n")),
        "_before": Scan("last", F.col("value"), inclusive=False),
    }
    counts = stage(counts, "value-counts")
    totals = counts.groupBy("column").agg(F.sum("ref_n").alias("_ref_total"), F.sum("cur_n").alias("_cur_total"))
    # One row per compared column.
    return ordered_scan(counts, ["column"], ["value"], scans, rows_per_chunk).join(F.broadcast(totals), "column")


def ks_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int | None = BINS, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Largest distance of the two distribution functions per column, with its asymptotic p-value.

    A column without a value on one side is not `comparable`: its statistic and p-value are null, and it
    has not drifted. A column without a value on either side gives no row.
    """
    gap = F.abs(F.try_divide("_ref_cum", "_ref_total") - F.try_divide("_cur_cum", "_cur_total"))
    scanned = _cumulative(value_counts(reference, current, columns, bins), rows_per_chunk)
    stats = scanned.groupBy("column").agg(
        F.max(gap).alias("statistic"),
        F.max("_ref_total").cast("double").alias("_n"),
        F.max("_cur_total").cast("double").alias("_m"),
    )
    x2 = F.pow(F.col("statistic"), 2) * F.col("_n") * F.col("_m") / (F.col("_n") + F.col("_m"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * x2),
    )
    p = F.when(x2 < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
    p = F.when(F.col("statistic").isNotNull(), p)
    drifted = F.coalesce(p < P_VALUE_LIMIT, F.lit(False))
    return stats.select("column", "statistic", p.alias("p_value"), drifted.alias("drifted"), F.col("statistic").isNotNull().alias("comparable"))


def _wasserstein(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int | None, rows_per_chunk: int) -> DataFrame:
    spread = reference.agg(*[F.stddev_pop(known(c)).alias(c) for c in columns]).unpivot([], list(columns), "column", "_std")
    return wasserstein_of(value_counts(reference, current, columns, bins), spread, rows_per_chunk)


def wasserstein_of(counts: DataFrame, spread: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Distances from `value_counts` rows and the reference's deviation `_std`, one row per column."""
    before_ref = F.try_divide(F.col("_ref_cum") - F.col("ref_n"), F.col("_ref_total"))
    before_cur = F.try_divide(F.col("_cur_cum") - F.col("cur_n"), F.col("_cur_total"))
    area = F.abs(before_ref - before_cur) * (F.col("value") - F.col("_before"))
    scanned = _cumulative(counts, rows_per_chunk)
    return (
        scanned.groupBy("column")
        .agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("_area"), F.max("_ref_total").alias("_n"), F.max("_cur_total").alias("_m"))
        .withColumn("_area", F.when((F.col("_n") > 0) & (F.col("_m") > 0), F.col("_area")))
        .join(F.broadcast(spread), "column")
        .select("column", F.lit("wasserstein").alias("method"), F.try_divide("_area", F.greatest(F.col("_std"), F.lit(STD_FLOOR))).alias("distance"))
    )


def category_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count of each value of each categorical column; a null value counts as its own category."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _category_pairs(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts and shares of each category on both sides, 0 where one side lacks it."""
    return pairs_of(category_frequencies(reference, columns), category_frequencies(current, columns))


def pairs_of(before: DataFrame, now: DataFrame) -> DataFrame:
    """The same from two tables of `category_frequencies`."""
    tagged = before.select("column", "value", F.col("n").alias("r"), F.lit(0).cast("bigint").alias("c"))
    tagged = tagged.unionByName(now.select("column", "value", F.lit(0).cast("bigint").alias("r"), F.col("n").alias("c")))
    pairs = tagged.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.sum("r").alias("ref_n"), F.sum("c").alias("cur_n"))
    totals = pairs.groupBy("column").agg(F.sum("ref_n").alias("ref_total"), F.sum("cur_n").alias("cur_total"))
    return pairs.join(F.broadcast(totals), "column").withColumns(
        {"ref_share": F.try_divide("ref_n", "ref_total"), "cur_share": F.try_divide("cur_n", "cur_total")}
    )


def jensen_shannon_of(pairs: DataFrame) -> DataFrame:
    r, c = F.col("ref_share"), F.col("cur_share")
    middle = (r + c) / 2

    def part(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / middle)).otherwise(F.lit(0.0))

    divergence = F.greatest(F.sum((part(r) + part(c)) / 2), F.lit(0.0))
    both = (F.max("ref_total") > 0) & (F.max("cur_total") > 0)
    return pairs.groupBy("column").agg(
        F.lit("jensenshannon").alias("method"), F.when(both, F.sqrt(divergence)).alias("distance")
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    bins: int | None = BINS,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Distance of each column: scaled Wasserstein for numbers, Jensen-Shannon for categories.

    A column without a value on one side is not `comparable`: its distance is null, and it has not drifted.
    With `bins=None` numbers are compared value by value.
    """
    parts = []
    if numeric:
        parts.append(_wasserstein(reference, current, numeric, bins, rows_per_chunk))
    if categorical:
        parts.append(jensen_shannon_of(_category_pairs(reference, current, categorical)))
    return judged(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))


def judged(both: DataFrame) -> DataFrame:
    drifted = F.coalesce(F.col("distance") >= COLUMN_DRIFT_LIMIT, F.lit(False))
    return both.withColumns({"drifted": drifted, "comparable": F.col("distance").isNotNull()})


def dataset_drift(columns: DataFrame) -> DataFrame:
    """Share of drifted columns; detected above 0.2."""
    return columns.agg(*_verdict(F.avg(F.col("drifted").cast("double")), DATASET_DRIFT_LIMIT))


def _upper_gamma_share(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function, by its series or its continued fraction."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * scale
    b, d = x + 1 - a, 1.0 / (x + 1 - a)
    c, h = 1e300, d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


@F.pandas_udf(T.DoubleType())
def chi2_p_value(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """P-value of a chi-square statistic; it runs on one row per compared column."""
    for statistic, dof in batches:
        yield pd.Series([_upper_gamma_share(k / 2, s / 2) if k > 0 else 1.0 for s, k in zip(statistic, dof)], dtype="float64")


def chi2_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], p_value: bool = True) -> DataFrame:
    """Chi-square of the current category counts against the reference shares.

    A category the reference lacks has no expected count; it is left out of the statistic.
    """
    expected = F.coalesce(F.col("ref_share") * F.col("cur_total"), F.lit(0.0))
    stats = (
        _category_pairs(reference, current, columns)
        .groupBy("column")
        .agg(
            F.sum(F.when(expected > 0, F.pow(F.col("cur_n") - expected, 2) / expected)).alias("statistic"),
            (F.count_if(expected > 0) - 1).alias("dof"),
        )
    )
    if not p_value:
        return stats
    return stats.withColumn("p_value", chi2_p_value("statistic", "dof")).withColumn("drifted", F.col("p_value") < P_VALUE_LIMIT)


def psi_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Population stability index per column over the reference deciles; null without a value on one side.

    A bin holds `edge < x <= next edge`; equal deciles are merged; the outer bins are open.
    """
    doubles = [known(F.col(c).cast("double")).alias(c) for c in columns]
    ref_long = reference.select(*doubles).unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    cur_long = current.select(*doubles).unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    deciles = percentiles(ref_long, ["column"], "value", {f"d{i}": i / 10 for i in range(1, 10)}, rows_per_chunk)
    edges = deciles.select("column", F.array_sort(F.array_distinct(F.array(*[f"d{i}" for i in range(1, 10)]))).alias("edges"))
    both = ref_long.withColumn("_cur", F.lit(0)).unionByName(cur_long.withColumn("_cur", F.lit(1)))
    # One row of nine edges per compared column.
    placed = both.join(F.broadcast(edges), "column")
    bin_no = F.size(F.filter("edges", lambda e: e < F.col("value")))
    counts = placed.groupBy("column", bin_no.alias("bin")).agg(
        F.count_if(F.col("_cur") == 0).alias("ref_n"), F.count_if(F.col("_cur") == 1).alias("cur_n")
    )
    totals = counts.groupBy("column").agg(F.sum("ref_n").alias("ref_total"), F.sum("cur_n").alias("cur_total"))
    both = (F.col("ref_total") > 0) & (F.col("cur_total") > 0)
    r = F.greatest(F.try_divide("ref_n", "ref_total"), F.lit(SHARE_FLOOR))
    c = F.greatest(F.try_divide("cur_n", "cur_total"), F.lit(SHARE_FLOOR))
    part = F.when(both, (c - r) * F.log(c / r))
    return counts.join(F.broadcast(totals), "column").groupBy("column").agg(F.sum(part).alias("psi"))

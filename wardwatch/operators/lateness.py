"""How late rows arrive: counts, ratio, tiers, lag behind the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.functions.timing import LATE_AFTER_MS, cell_start, delay_ms, is_late
from wardwatch.operators.ordered import ROWS_PER_CHUNK, Scan, ordered_scan

# The documented tiers, watermark 2 minutes plus 3 minutes of allowed lateness.
ON_TIME_MS, ALLOWED_MS = 120_000, 300_000


def late_flag(limit_ms: int = LATE_AFTER_MS) -> Column:
    return is_late(delay_ms(F.col("arrival_ms"), F.col("event_ms")), limit_ms)


def late_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_data_count"),
        F.count_if(late_flag()).alias("late_data_count"),
    )


def late_ratio(counts: DataFrame) -> DataFrame:
    """Share of late rows, 0 where there are none at all."""
    share = F.try_divide(F.col("late_data_count").cast("double"), F.col("total_data_count"))
    return counts.withColumn("late_data_ratio", F.coalesce(share, F.lit(0.0)))


def late_ratio_by_window(df: DataFrame, width_ms: int) -> DataFrame:
    cells = df.withColumn("window_ms", cell_start(F.col("event_ms"), width_ms))
    return late_ratio(late_counts(cells, ["window_ms"]))


def tier(behind: Column) -> Column:
    on_time = behind.isNull() | (behind <= ON_TIME_MS)
    return F.when(on_time, F.lit("on_time")).when(behind <= ALLOWED_MS, F.lit("allowed_late")).otherwise(F.lit("side_output"))


def lateness_tiers(df: DataFrame, prior: DataFrame | None = None, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Sort rows into tiers by how far they lie behind the newest event that arrived before them.

    The newest event is tracked per source partition, as a streaming source does. `prior` holds
    `(source_partition, seen_ms)` from earlier batches; its size is the number of source partitions.
    """
    seen = {"_seen": Scan("max", F.col("event_ms"), inclusive=False)}
    scanned = ordered_scan(df, ["source_partition"], ["arrival_ms", "event_id"], seen, rows_per_chunk)
    newest = F.col("_seen")
    if prior is not None:
        before = prior.select("source_partition", F.col("seen_ms").alias("_before"))
        scanned = scanned.join(before, "source_partition", "left")
        newest = F.greatest(newest, F.col("_before"))
    behind = newest - F.col("event_ms")
    return scanned.withColumns({"behind_ms": behind, "tier": tier(behind)}).drop("_seen", "_before")


def newest_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source_partition").agg(F.max("event_ms").alias("seen_ms"))


def event_time_lag(df: DataFrame, width_ms: int = 60_000) -> DataFrame:
    """Largest delay between event and arrival per window of arrival time."""
    cell = cell_start(F.col("arrival_ms"), width_ms).alias("window_ms")
    return df.groupBy(cell).agg(F.max(delay_ms(F.col("arrival_ms"), F.col("event_ms"))).alias("lag_ms"))

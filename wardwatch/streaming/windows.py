"""Event-time windows. The same expressions run on a table and on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.functions.timing import ms_to_ts

# The coded and the documented bounds of disorder.
CODED_DELAY, DOCUMENTED_DELAY, ALLOWED_DELAY = "5 seconds", "2 minutes", "5 minutes"


def assign_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", ms_to_ts(F.col("event_ms")))


def with_watermark(df: DataFrame, delay: str = DOCUMENTED_DELAY) -> DataFrame:
    return assign_event_time(df).withWatermark("event_time", delay)


def tumbling_vitals(df: DataFrame, width: str = "1 minute", by: Sequence[str] = ("discharge_destination",), delay: str = ALLOWED_DELAY) -> DataFrame:
    """Counts, mean glucose, highest BMI and lateness per tumbling window and group.

    On a stream in update mode, rows within `delay` still revise their window. Rows are partly
    aggregated before the shuffle, so a busy group costs one row per task and window.
    """
    timed = with_watermark(df, delay) if df.isStreaming else assign_event_time(df)
    out = timed.groupBy(F.window("event_time", width), *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("glucose_level").alias("mean_glucose"),
        F.max("bmi").alias("max_bmi"),
        F.max(F.col("arrival_ms") - F.col("event_ms")).alias("max_delay_ms"),
    )
    return out.select(F.unix_millis("window.start").alias("window_ms"), *by, "n", "mean_glucose", "max_bmi", "max_delay_ms")


def window_means(df: DataFrame, columns: Sequence[str], width: str = "60 seconds", delay: str = ALLOWED_DELAY) -> DataFrame:
    """Row count and column means per window: what a drift check needs of a stream."""
    timed = with_watermark(df, delay) if df.isStreaming else assign_event_time(df)
    out = timed.groupBy(F.window("event_time", width)).agg(F.count(F.lit(1)).alias("n_rows"), *[F.avg(c).alias(c) for c in columns])
    return out.select(F.unix_millis("window.start").alias("window_ms"), "n_rows", *columns)

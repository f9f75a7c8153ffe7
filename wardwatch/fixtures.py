"""Views over the given tables that have the shape of vitals events, requests and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.operators.ordered import Scan, ordered_scan, plan_splits, settle

VITALS_VIEW = """
SELECT event_id, cast(user_id AS varchar(20)) AS patient_id, ts, {ms} AS event_ms,
  {ms} + CASE WHEN event_id % 10 = 0 THEN 60000 + (event_id * 7919) % 300001 ELSE (event_id * 31) % 2000 END AS arrival_ms,
  user_id % 4 AS source_partition,
  18 + user_id % 73 AS age,
  CASE user_id % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
  CASE WHEN event_id % 97 = 0 THEN 'n/a'
       ELSE concat(cast(100 + event_id % 66 AS varchar(10)), '/', cast(60 + (event_id * 7) % 43 AS varchar(10))) END AS blood_pressure,
  70 + value AS glucose_level,
  150 + (event_id * 11) % 151 AS cholesterol,
  18 + ((event_id * 13) % 221) / 10e0 AS bmi,
  CASE WHEN (user_id * 5) % 7 < 3 THEN 'Yes' ELSE 'No' END AS diabetes,
  CASE WHEN (user_id * 3) % 5 < 2 THEN 'Yes' ELSE 'No' END AS hypertension,
  event_id % 11 AS medication_count,
  1 + event_id % 10 AS length_of_stay,
  CASE user_id % 4 WHEN 1 THEN 'Nursing_Facility' WHEN 2 THEN 'Rehab' ELSE 'Home' END AS discharge_destination,
  CASE WHEN (event_id * 37) % 100 < 10 + CASE WHEN user_id % 73 > 42 THEN 20 ELSE 0 END
            + CASE WHEN (user_id * 5) % 7 < 3 THEN 15 ELSE 0 END THEN 'Yes' ELSE 'No' END AS readmitted_30_days
FROM {events}
"""

SPARK_MS = "unix_millis(cast(ts as timestamp))"
SPLIT_DAY, HALF_DAY = "2024-01-21", "2024-01-16"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_vitals(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Works on a table and on a stream of events alike."""
    return spark.sql(VITALS_VIEW.format(ms=SPARK_MS, events="{events}"), events=df)


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_vitals(spark, events(spark, sf_dir))


def vitals_with_unknown(spark: SparkSession, sf_dir: str, everywhere: bool = True) -> DataFrame:
    """Vitals whose missing pressures are text without two parts, everywhere or in every other source."""
    unknown = F.col("blood_pressure") == "n/a"
    if not everywhere:
        unknown = unknown & (F.col("source_partition") % 2 == 0)
    return vitals(spark, sf_dir).withColumn("blood_pressure", F.when(unknown, F.lit("unknown")).otherwise(F.col("blood_pressure")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "error").when(F.col("value") > 100, "timeout").otherwise("success")
    return events(spark, sf_dir).select(
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.col("event_type").alias("source"),
        F.col("value").alias("latency_ms"),
        status.alias("status"),
    )


def counter(spark: SparkSession, sf_dir: str, failed_only: bool = False) -> DataFrame:
    """A counter per source, of all or of failed requests, that resets at every thousandth; one sample per millisecond."""
    rows = requests(spark, sf_dir)
    rows = (rows.where(F.col("status") != "success") if failed_only else rows).select("source", "ms", "event_id")
    splits = plan_splits(rows, ["source"], ["ms", "event_id"])
    numbered = ordered_scan(rows, ["source"], ["ms", "event_id"], {"_no": Scan("count")}, None, splits)
    value = F.max_by((F.col("_no") % 1000).cast("double"), F.col("event_id"))
    return settle(numbered.groupBy("source", "ms").agg(value.alias("value")), splits, "counter")


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vitals(spark, sf_dir).where(F.col("ts") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = vitals(spark, sf_dir).where(F.col("ts") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    return late.withColumn("glucose_level", F.col("glucose_level") * 1.3)


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = vitals(spark, sf_dir)
    middle = F.lit(HALF_DAY).cast("timestamp_ntz")
    return rows.where(F.col("ts") < middle), rows.where(F.col("ts") >= middle)

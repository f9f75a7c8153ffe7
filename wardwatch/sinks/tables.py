"""Writing predictions, metrics, reports and stores. Every write of a stream replaces its own batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.functions.records import as_json
from wardwatch.schemas import METRICS


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch under its id; a replay of the batch replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions as JSON text, one string column."""
    as_json(df).write.mode("overwrite").text(path)


def write_topic(df: DataFrame, brokers: str, topic: str) -> None:
    """Predictions to a topic, keyed by patient; needs the Kafka connector."""
    keyed = df.select(F.col("patient_id").cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    keyed.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def latest_revision(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of a table written in update mode, the newest revision of each key."""
    rest = [c for c in df.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("_r")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def as_metrics(df: DataFrame, values: list[str], job: str, ts_ms: Column, labels: list[str] | None = None) -> DataFrame:
    """Value columns as rows of the metric table; a null value gives no row."""
    tags = F.create_map(F.lit("job"), F.lit(job), *[x for c in labels or [] for x in (F.lit(c), F.col(c).cast("string"))])
    pairs = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values])
    rows = df.select(tags.alias("labels"), ts_ms.cast("bigint").alias("ts_ms"), F.explode(pairs).alias("_m"))
    return rows.where(F.col("_m.value").isNotNull()).select("_m.metric", "labels", "ts_ms", "_m.value")


def emit_metrics(metrics: DataFrame, path: str) -> None:
    """Append to the metric table, one folder per metric."""
    metrics.write.mode("append").partitionBy("metric").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)


def write_report(summary: DataFrame, errors: DataFrame, path: str, keep: int = 100) -> None:
    """A report of one row and the first errors next to it."""
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    errors.orderBy("ms", "event_id").limit(keep).coalesce(1).write.mode("overwrite").json(f"{path}/errors")

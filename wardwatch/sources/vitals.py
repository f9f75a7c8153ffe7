"""Reading vitals and predictions: files or a topic, as a table or as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.functions.timing import ms_to_ts, now_ms
from wardwatch.schemas import PATIENTS_CSV, VITALS, VITALS_JSON

# Names under which start policies are known elsewhere.
START_POLICIES = {"earliest": "earliest", "latest": "latest", "latest-offset": "latest"}

# Rows taken in per trigger are bounded, and with them the rows of one patient in one batch.
TOPIC_ROWS_PER_TRIGGER = 5_000_000
FILES_PER_TRIGGER = 256

# How far an event's clock may be ahead of its arrival.
AHEAD_MS = 300_000


def parse_vitals(df: DataFrame, column: str = "value", schema: T.StructType = VITALS_JSON, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode JSON objects. Text that is no JSON object is skipped; a field of the wrong type is null.

    The event time comes from `ts`, or from `timestamp` where `ts` is absent.
    """
    text = F.col(column).cast("string")
    is_object = F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT")
    parsed = df.where(F.coalesce(is_object, F.lit(False))).select(*keep, F.from_json(text, schema).alias("_e"))
    fields = schema.fieldNames()
    if "ts" not in fields or "timestamp" not in fields:
        return parsed.select(*keep, "_e.*")
    rest = [F.col(f"_e.{c}").alias(c) for c in fields if c not in ("ts", "timestamp")]
    return parsed.select(*keep, *rest, F.coalesce("_e.ts", "_e.timestamp").alias("event_ms"))


def with_arrival(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add the arrival time: from a timestamp column of the source, or the time of processing."""
    arrival = F.unix_millis(F.col(source)) if source else now_ms()
    return df.withColumn("arrival_ms", arrival)


def arrival_timestamp(df: DataFrame) -> DataFrame:
    return df.withColumn("arrival_time", ms_to_ts(F.col("arrival_ms")))


def event_time_error(df: DataFrame, ahead_ms: int = AHEAD_MS) -> DataFrame:
    """A row without an event time is an error, not a row at time zero, and so is one far ahead of its arrival.

    Such a clock would otherwise expire what all others have sent.
    """
    kept = [F.col("error")] if "error" in df.columns else []
    missing = F.when(F.col("event_ms").isNull(), F.lit("missing_event_time"))
    ahead = [F.when(F.col("event_ms") - F.col("arrival_ms") > ahead_ms, F.lit("event_time_ahead"))] if "arrival_ms" in df.columns else []
    return df.withColumn("error", F.coalesce(*kept, missing, *ahead))


def vitals_table(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A table of patients or vitals: CSV with a header, JSON lines or Parquet."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "json" if path.endswith(".json") else "parquet")
    if fmt == "csv":
        return spark.read.schema(schema or PATIENTS_CSV).option("header", True).csv(path)
    if fmt == "json":
        return spark.read.schema(schema or VITALS).json(path)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def start_options(starting: str, fmt: str = "kafka") -> dict[str, str]:
    """The option for a start policy. Files have no offsets to start from, so there only `earliest` has a meaning."""
    if starting not in START_POLICIES:
        raise ValueError(f"start policy {starting}: one of {sorted(START_POLICIES)}")
    if fmt == "kafka":
        return {"startingOffsets": START_POLICIES[starting]}
    if START_POLICIES[starting] != "earliest":
        raise ValueError(f"start policy {starting} needs a topic; files are read from the first on")
    return {}


def _topic_options(brokers: str, topic: str, starting: str, extra: Mapping[str, str]) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "subscribe": topic, **start_options(starting), **extra}


def topic_stream(spark: SparkSession, brokers: str, topic: str, starting: str = "latest", group: str | None = None, **extra: str) -> DataFrame:
    """Events of a topic with the broker's arrival time and the partition; needs the Kafka connector."""
    options = _topic_options(brokers, topic, starting, extra)
    options.setdefault("maxOffsetsPerTrigger", str(TOPIC_ROWS_PER_TRIGGER))
    if group:
        options["kafka.group.id"] = group
    return decode_topic(spark.readStream.format("kafka").options(**options).load())


def decode_topic(raw: DataFrame) -> DataFrame:
    """Topic records `(value, timestamp, partition)` as vitals rows."""
    named = raw.select("value", F.unix_millis("timestamp").alias("arrival_ms"), F.col("partition").cast("bigint").alias("source_partition"))
    return parse_vitals(named, keep=("arrival_ms", "source_partition"))


def topic_table(spark: SparkSession, brokers: str, topic: str, **extra: str) -> DataFrame:
    """A topic from its start to now."""
    return spark.read.format("kafka").options(**_topic_options(brokers, topic, "earliest", extra)).load()


def vitals_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = VITALS,
    files_per_trigger: int = FILES_PER_TRIGGER,
    starting: str = "earliest",
    **extra: str,
) -> DataFrame:
    """New files of a folder as a stream. JSON text files go through `parse_vitals`."""
    extra = {**start_options(starting, fmt), **extra}
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).options(**extra)
    if fmt == "text":
        return with_arrival(parse_vitals(reader.format("text").load(path)))
    return reader.format(fmt).schema(schema).load(path)


def predictions_table(spark: SparkSession, path: str) -> DataFrame:
    """All predictions a stream has written so far, each batch once."""
    return spark.read.option("recursiveFileLookup", False).parquet(path)

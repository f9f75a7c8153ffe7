"""Metrics of running queries, taken from their progress reports."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from wardwatch.schemas import METRICS
from wardwatch.sinks.tables import emit_metrics

#: Rows held before they are written, where a table is named.
FLUSH_ROWS = 10_000


def _ms(text: str) -> int:
    return int(datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() * 1000)


def _offsets(value) -> dict[tuple[str, str], int]:
    """Offsets by topic and partition; other sources have none."""
    value = json.loads(value) if isinstance(value, str) and value.startswith("{") else value
    if not isinstance(value, dict):
        return {}
    return {(t, p): int(n) for t, parts in value.items() if isinstance(parts, dict) for p, n in parts.items()}


def progress_rows(report: dict) -> list[tuple[str, dict[str, str], int, float]]:
    """Metric rows of one progress report: rates, lags, checkpoint time and state size."""
    query = report.get("name") or report.get("id") or "query"
    at = _ms(report["timestamp"])
    rows: list[tuple[str, dict[str, str], int, float]] = []

    def add(metric: str, value, **labels: str) -> None:
        if value is not None:
            rows.append((metric, {"query": str(query), **labels}, at, float(value)))

    add("input_rows_total", report.get("numInputRows"))
    add("processed_rows_per_second", report.get("processedRowsPerSecond"))
    duration = report.get("durationMs") or {}
    if "walCommit" in duration or "commitOffsets" in duration:
        add("checkpoint_duration_ms", duration.get("walCommit", 0) + duration.get("commitOffsets", 0))
    add("batch_duration_ms", duration.get("triggerExecution"))
    event_time = report.get("eventTime") or {}
    if event_time.get("max"):
        add("event_time_lag_ms", at - _ms(event_time["max"]))
    for state in report.get("stateOperators") or []:
        add("state_size_bytes", state.get("memoryUsedBytes"), operator=str(state.get("operatorName", "")))
        add("state_rows", state.get("numRowsTotal"), operator=str(state.get("operatorName", "")))
    for source in report.get("sources") or []:
        newest, read = _offsets(source.get("latestOffset")), _offsets(source.get("endOffset"))
        for (topic, partition), offset in newest.items():
            add("kafka_consumergroup_lag", offset - read.get((topic, partition), 0), topic=topic, partition=partition)
    return rows


class ProgressMetrics(StreamingQueryListener):
    """Collects the metric rows of all queries of a session until they are flushed to the metric table.

    No row is dropped. With a session and a path, rows are written whenever `FLUSH_ROWS` have gathered;
    otherwise call `flush` now and then. Rows leave the memory only after they have been written.
    """

    def __init__(self, spark: SparkSession | None = None, path: str | None = None) -> None:
        self.rows: list = []
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.extend(progress_rows(json.loads(event.progress.json)))
        if self.path and len(self.rows) >= FLUSH_ROWS:
            self.flush(self.spark, self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), METRICS)

    def flush(self, spark: SparkSession, path: str) -> None:
        taken = self.rows[:]
        if taken:
            emit_metrics(spark.createDataFrame(taken, METRICS).coalesce(1), path)
            del self.rows[: len(taken)]

"""A watcher of drift on a stream: it checks after so many rows or when its timer runs out, whichever comes first."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wardwatch.operators.drift import WATCH_TIMER_MS, WINDOW_CARRY, WINDOW_MIN_ROWS, WINDOW_ROWS, known, score_window_means
from wardwatch.operators.lateness import late_flag
from wardwatch.session import ship

ship(__name__)

COUNTS = "rows BIGINT, late BIGINT, cell BIGINT, part BIGINT, last_ms BIGINT, sums ARRAY<DOUBLE>, counts ARRAY<BIGINT>, carried BIGINT, carried_sums ARRAY<DOUBLE>, carried_counts ARRAY<BIGINT>"
TAIL = "row ARRAY<DOUBLE>"


@dataclass
class Watch:
    """What a watcher keeps between batches: counters, running sums since its last check, and the last `carry` rows.

    A value that is missing is NaN. `carried` are the rows handed over from before the last check.
    """

    width: int
    timer_ms: int
    size: int
    carry: int
    at_least: int
    rows: int = 0
    late: int = 0
    cell: int | None = None
    part: int = 0
    last_ms: int = 0
    sums: np.ndarray = field(default=None)
    counts: np.ndarray = field(default=None)
    carried: int = 0
    carried_sums: np.ndarray = field(default=None)
    carried_counts: np.ndarray = field(default=None)
    tail: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        for name in ("sums", "carried_sums"):
            setattr(self, name, np.zeros(self.width) if getattr(self, name) is None else np.asarray(getattr(self, name), float))
        for name in ("counts", "carried_counts"):
            setattr(self, name, np.zeros(self.width, np.int64) if getattr(self, name) is None else np.asarray(getattr(self, name), np.int64))
        self.tail = np.empty((0, self.width)) if self.tail is None else self.tail

    def state(self) -> tuple:
        numbers = (self.rows, self.late, self.cell, self.part, self.last_ms, self.sums.tolist(), self.counts.tolist())
        return (*numbers, self.carried, self.carried_sums.tolist(), self.carried_counts.tolist())

    def check(self) -> dict[str, Any] | None:
        """End the rows since the last check, and tell what they hold; None below `at_least` rows."""
        if not self.part:
            return None
        n = self.part + self.carried
        row = None
        if n >= self.at_least:
            counted = self.counts + self.carried_counts
            total = self.sums + self.carried_sums
            means = [float(t / c) if c else None for t, c in zip(total, counted)]
            row = {"row_no": self.rows, "t_ms": self.last_ms, "n_rows": n, "late_data_count": self.late, "means": means}
        there = ~np.isnan(self.tail)
        self.carried, self.carried_sums, self.carried_counts = len(self.tail), np.where(there, self.tail, 0).sum(0), there.sum(0)
        self.part, self.sums, self.counts = 0, np.zeros(self.width), np.zeros(self.width, np.int64)
        return row

    def add(self, arrival_ms: np.ndarray, late: np.ndarray, values: np.ndarray) -> Iterator[dict[str, Any]]:
        """Rows in order of arrival; yields the checks that they bring about."""
        cells = np.maximum.accumulate(np.maximum(arrival_ms // self.timer_ms, self.cell if self.cell is not None else np.iinfo(np.int64).min))
        at = 0
        while at < len(cells):
            if self.cell is not None and cells[at] > self.cell:
                row = self.check()
                if row:
                    yield row
            self.cell = int(cells[at])
            stop = min(int(np.searchsorted(cells, self.cell, "right")), at + self.size - self.carry - self.part)
            taken = values[at:stop]
            there = ~np.isnan(taken)
            self.sums = self.sums + np.where(there, taken, 0).sum(0)
            self.counts = self.counts + there.sum(0)
            self.tail = np.concatenate([self.tail, taken[-self.carry :]])[-self.carry :] if self.carry else self.tail
            self.late += int(late[at:stop].sum())
            self.rows, self.part, self.last_ms = self.rows + stop - at, self.part + stop - at, int(arrival_ms[stop - 1])
            if self.part == self.size - self.carry:
                row = self.check()
                if row:
                    yield row
            at = stop


class DriftWatcher(StatefulProcessor):
    """Counts rows in order of arrival, and wakes by a timer of the wall clock when no row comes."""

    def __init__(self, key: str, columns: Sequence[str], timer_ms: int, size: int, carry: int, at_least: int, idle_ms: int):
        self.key, self.columns, self.idle_ms = key, list(columns), idle_ms
        self.limits = (len(self.columns), timer_ms, size, carry, at_least)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", COUNTS)
        self.tail = handle.getListState("tail", TAIL)

    def _load(self) -> Watch:
        if not self.counts.exists():
            return Watch(*self.limits)
        tail = [list(row[0]) for row in self.tail.get()] if self.tail.exists() else []
        return Watch(*self.limits, *self.counts.get(), tail=np.array(tail, float).reshape(len(tail), len(self.columns)))

    def _save(self, watch: Watch) -> None:
        self.counts.update(watch.state())
        if len(watch.tail):
            self.tail.put([(row,) for row in watch.tail.tolist()])

    def _frames(self, key: Any, rows: list[dict[str, Any]]) -> Iterator[pd.DataFrame]:
        if not rows:
            return
        names = ["row_no", "t_ms", "n_rows", "late_data_count"]
        out = pd.DataFrame({self.key: pd.Series([key[0]] * len(rows), dtype=object), **{name: [r[name] for r in rows] for name in names}})
        for i, column in enumerate(self.columns):
            out[column] = pd.Series([r["means"][i] for r in rows], dtype="float64")
        yield out

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        watch = self._load()
        pieces = [(f["arrival_ms"].to_numpy("int64"), f["event_id"].fillna(-1).to_numpy("int64"), f["late"].to_numpy(bool), f[self.columns].to_numpy(float)) for f in rows]
        arrival, ids, late, values = (np.concatenate(part) for part in zip(*pieces))
        order = np.lexsort((ids, arrival))
        found = list(watch.add(arrival[order], late[order], values[order]))
        self._save(watch)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if watch.part:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from self._frames(key, found)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        watch = self._load()
        found = watch.check()
        self._save(watch)
        yield from self._frames(key, [found] if found else [])

    def close(self) -> None:
        pass


def drift_watch_stream(
    df: DataFrame,
    reference: DataFrame | dict,
    columns: Sequence[str],
    by: str | None = None,
    timer_ms: int = WATCH_TIMER_MS,
    size: int = WINDOW_ROWS,
    carry: int = WINDOW_CARRY,
    at_least: int = WINDOW_MIN_ROWS,
    idle_ms: int | None = None,
) -> DataFrame:
    """The checks of `drift_watch`, made while the stream runs, with the share of late rows so far.

    A check is made when `size - carry` new rows have come, when a row arrives after a multiple of `timer_ms` was
    passed, or when `idle_ms` (by default `timer_ms`) of the wall clock have gone by without a row. State holds running
    sums and `carry` rows, never the rows since the last check. `by` names a column with a watcher for each of
    its values, such as the partition of a topic: one watcher's rows of a batch are put in order in one task, as numbers.
    """
    key = by or "watch"
    values = [known(F.col(c).cast("double")).alias(c) for c in columns]
    named = F.col(by).cast("string") if by else F.lit("all")
    slim = df.select(named.alias(key), F.col("arrival_ms").cast("bigint"), F.col("event_id").cast("bigint"), F.coalesce(late_flag(), F.lit(False)).alias("late"), *values)
    schema = f"`{key}` STRING, row_no BIGINT, t_ms BIGINT, n_rows BIGINT, late_data_count BIGINT, " + ", ".join(f"`{c}` DOUBLE" for c in columns)
    watcher = DriftWatcher(key, columns, timer_ms, size, carry, at_least, timer_ms if idle_ms is None else idle_ms)
    checks = slim.groupBy(key).transformWithStateInPandas(watcher, outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")
    rated = checks.withColumn("late_data_ratio", F.col("late_data_count") / F.col("row_no"))
    return score_window_means(rated, [*([key] if by else []), "row_no", "t_ms", "late_data_count", "late_data_ratio"], reference, columns)

"""Alerts on a stream: a state machine per series that speaks only when its state changes."""

from __future__ import annotations

import math
from collections.abc import Iterator, MutableMapping, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wardwatch.functions.timing import ms_to_ts
from wardwatch.operators.alerts import STALE_MS, AlertRule, alert_text
from wardwatch.session import ship

ship(__name__)

TRANSITIONS = "at_ms BIGINT, state STRING, since_ms BIGINT, value DOUBLE"
#: A sample that waits; a value of NaN stands for none.
SAMPLE = np.dtype([("at", "<i8"), ("value", "<f8"), ("holds", "i1")])
#: Samples of one entry of the state, and those taken in at a time.
CHUNK, ROUND = 20_000, 2_000_000
#: Rows of one frame that is handed to Spark.
FRAME_ROWS = 20_000
INACTIVE, PENDING, FIRING, RESOLVED = "inactive", "pending", "firing", "resolved"


@dataclass
class AlertMachine:
    """inactive, pending since a true sample, firing once the condition has held for `hold_ms`, then resolved.

    Samples come in order of time. A condition holds from a true sample to the next sample, or for `max_gap_ms` where none
    comes; so the alert fires at the very end of its hold, and goes stale, without a sample. A sample at the moment of a
    deadline is taken first.
    """

    hold_ms: int
    max_gap_ms: int
    since: int | None = None
    last: int | None = None
    value: float | None = None
    firing: bool = False

    def deadline(self) -> int | None:
        """The next moment at which the state changes by itself."""
        if self.since is None:
            return None
        stale = self.last + self.max_gap_ms
        fires = self.since + self.hold_ms
        return fires if not self.firing and fires <= stale else stale

    def pass_deadlines(self, before: int) -> Iterator[tuple]:
        """Changes at deadlines earlier than a moment."""
        while (at := self.deadline()) is not None and at < before:
            if not self.firing and at == self.since + self.hold_ms:
                self.firing = True
                yield at, FIRING, self.since, self.value
            else:
                yield self._end(at, self.value)

    def _end(self, at: int, value: float | None) -> tuple:
        row = (at, RESOLVED if self.firing else INACTIVE, self.since, value)
        self.since = self.last = self.value = None
        self.firing = False
        return row

    def sample(self, at: int, value: float | None, on: bool) -> Iterator[tuple]:
        yield from self.pass_deadlines(at)
        if on:
            if self.since is None:
                self.since = at
                if self.hold_ms > 0:
                    yield at, PENDING, at, value
                else:
                    self.firing = True
                    yield at, FIRING, at, value
            self.last, self.value = at, value
        elif self.since is not None:
            yield self._end(at, value)


def advance(machine: AlertMachine, waiting: MutableMapping[int, tuple[float | None, bool]], upto: int) -> Iterator[tuple]:
    """Take the waiting samples up to a moment that no further sample can precede, then the deadlines up to it."""
    for at in sorted(t for t in waiting if t <= upto):
        yield from machine.sample(at, *waiting[at])
        del waiting[at]
    yield from machine.pass_deadlines(upto + 1)


def _packed(frame: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(frame), SAMPLE)
    out["at"], out["holds"] = frame["t_ms"].astype("int64"), frame["holds"].astype("bool")
    out["value"] = pd.to_numeric(frame["value"]).astype("float64")
    return out


def _largest(rows: np.ndarray) -> np.ndarray:
    """In order of time; of samples of one time the largest counts, and one with a value before one without."""
    known = ~np.isnan(rows["value"])
    rows = rows[np.lexsort((rows["holds"], np.where(known, rows["value"], 0.0), known, rows["at"]))]
    return rows[np.append(rows["at"][1:] != rows["at"][:-1], True)] if len(rows) > 1 else rows


class Waiting:
    """Samples that wait for the watermark, in chunks of up to `CHUNK` that follow each other in time.

    The state store holds a chunk under the time of its first sample. New samples rewrite only the chunks that they fall
    into, and what the watermark has passed is read once, so a series costs a call for each chunk and not for each sample.
    """

    def __init__(self, state: Any):
        self.state = state
        self.starts = sorted(key[0] for key in state.keys())

    def _load(self, start: int) -> np.ndarray:
        return np.frombuffer(bytes(self.state.getValue((start,))[0]), SAMPLE)

    def _replace(self, start: int | None, rows: np.ndarray) -> list[int]:
        """Rows in place of a chunk; returns where they start."""
        pieces = np.array_split(rows, -(-len(rows) // CHUNK)) if len(rows) else []
        starts = [int(piece["at"][0]) for piece in pieces]
        if start is not None and start not in starts:
            self.state.removeKey((start,))
        for at, piece in zip(starts, pieces):
            self.state.updateValue((at,), (piece.tobytes(),))
        return starts

    def put(self, rows: np.ndarray) -> None:
        rows, starts = _largest(rows), []
        # Samples before the first chunk go into it.
        owns = np.split(rows, np.searchsorted(rows["at"], self.starts[1:]))
        for start, own in zip(self.starts or [None], owns):
            if start is None:
                starts += self._replace(None, own)
            else:
                starts += self._replace(start, _largest(np.concatenate([self._load(start), own]))) if len(own) else [start]
        self.starts = starts

    def take(self, upto: int) -> Iterator[dict[int, tuple[float | None, bool]]]:
        """The samples up to a moment, a chunk at a time; they no longer wait."""
        while self.starts and self.starts[0] <= upto:
            start = self.starts[0]
            rows = self._load(start)
            n = int(np.searchsorted(rows["at"], upto, "right"))
            self.starts = self._replace(start, rows[n:]) + self.starts[1:]
            values = [None if math.isnan(v) else v for v in rows["value"][:n].tolist()]
            yield dict(zip(rows["at"][:n].tolist(), zip(values, (rows["holds"][:n] > 0).tolist())))


class AlertProcessor(StatefulProcessor):
    """Samples wait until the watermark has passed them; one timer per series stands at the next sample or deadline."""

    def __init__(self, keys: Sequence[str], hold_ms: int, max_gap_ms: int):
        self.keys, self.hold_ms, self.max_gap_ms = list(keys), hold_ms, max_gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", "since BIGINT, last BIGINT, value DOUBLE, firing BOOLEAN")
        self.waiting = handle.getMapState("samples", "at BIGINT", "samples BINARY")

    def _changes(self, machine: AlertMachine, waiting: Waiting, watermark: int) -> Iterator[tuple]:
        for samples in waiting.take(watermark):
            yield from advance(machine, samples, max(samples))
        yield from advance(machine, {}, watermark)

    def _advance(self, key: Any, waiting: Waiting, watermark: int) -> Iterator[pd.DataFrame]:
        held = self.machine.get() if self.machine.exists() else ()
        machine = AlertMachine(self.hold_ms, self.max_gap_ms, *held)
        changes = self._changes(machine, waiting, watermark)
        while rows := list(islice(changes, FRAME_ROWS)):
            columns = {name: [key[i]] * len(rows) for i, name in enumerate(self.keys)}
            yield pd.DataFrame({**columns, **{n.split()[0]: [r[i] for r in rows] for i, n in enumerate(TRANSITIONS.split(", "))}}, dtype=object)
        if machine.since is None:
            self.machine.clear()
        else:
            self.machine.update((machine.since, machine.last, machine.value, machine.firing))
        moments = [t for t in (*waiting.starts[:1], machine.deadline()) if t is not None]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if moments:
            self.handle.registerTimer(max(min(moments), watermark + 1))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        waiting, held, n = Waiting(self.waiting), [], 0
        for frame in rows:
            held.append(_packed(frame))
            n += len(frame)
            if n >= ROUND:
                waiting.put(np.concatenate(held))
                held, n = [], 0
        if held:
            waiting.put(np.concatenate(held))
        yield from self._advance(key, waiting, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, Waiting(self.waiting), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def alert_changes_stream(series: DataFrame, keys: Sequence[str], condition: Column, hold_ms: int, max_gap_ms: int = STALE_MS, delay: str = "1 minute") -> DataFrame:
    """Of each series `(keys, t_ms, value)` the changes of its alert: `at_ms, state, since_ms, value`.

    Samples may come out of order by as much as `delay`; later ones are too late to change what was said, and Spark drops
    them. An alert fires and goes stale when the watermark, which all series move, passes that moment. A series
    without any state costs nothing. Equals `alert_changes` of the same samples up to the watermark.
    """
    names = list(keys) or ["series"]
    named = [F.col(k).cast("string").alias(k) for k in keys] or [F.lit("all").alias("series")]
    timed = series.withColumn("_time", ms_to_ts(F.col("t_ms"))).withWatermark("_time", delay)
    slim = timed.where("t_ms IS NOT NULL").select(*named, "t_ms", F.col("value").cast("double").alias("value"), F.coalesce(condition, F.lit(False)).alias("holds"), "_time")
    schema = ", ".join([*[f"`{n}` STRING" for n in names], TRANSITIONS])
    out = slim.groupBy(*names).transformWithStateInPandas(AlertProcessor(names, hold_ms, max_gap_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    return out if keys else out.drop("series")


def rule_changes_stream(series: DataFrame, rule: AlertRule, keys: Sequence[str] = (), max_gap_ms: int = STALE_MS, delay: str = "1 minute") -> DataFrame:
    """The changes of a rule with the text to send: what an alert manager is told."""
    changes = alert_changes_stream(series, keys, rule.condition(F.col("value")), rule.hold_ms, max_gap_ms, delay)
    text = F.when(F.col("state").isin(PENDING, FIRING), alert_text(rule, F.col("value")))
    return changes.withColumns({"alert": F.lit(rule.name), "severity": F.lit(rule.severity), "description": text})

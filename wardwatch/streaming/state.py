"""Keyed state of a stream: the recent readings of each patient in order of event time, kept in the state store.

Patients are kept together in buckets, so that a batch costs some calls for each bucket and not for each patient.
"""

from __future__ import annotations

from collections.abc import Iterator, MutableMapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wardwatch.operators.history import HOUR_MS
from wardwatch.session import ship

ship(__name__)

OUTPUT = (
    "patient_id STRING, event_id BIGINT, event_ms BIGINT, risk_score DOUBLE, anomaly BOOLEAN, error STRING, previous_ms BIGINT,"
    " glucose_change DOUBLE, systolic_change DOUBLE, diastolic_change DOUBLE, bp_change DOUBLE,"
    " previous_readmission_risk DOUBLE, previous_anomaly BOOLEAN"
)
#: A stored reading: numbers as NaN, flags as -1, ids and times as `NONE` where null; `error` and `who` count into lists of texts.
NUMBERS = {"glucose": "glucose_level", "systolic": "systolic", "diastolic": "diastolic", "risk": "risk_score"}
READING = np.dtype(
    [("who", "<i4"), ("ms", "<i8"), ("id", "<i8"), *[(n, "<f8") for n in NUMBERS], ("anomaly", "i1"), ("error", "<i4"), ("previous_ms", "<i8"), ("previous_id", "<i8")]
)
NONE = np.iinfo(np.int64).min
#: Rows of one frame that is handed to Spark.
FRAME_ROWS = 20_000
#: Buckets of patients; a checkpoint keeps the number that it began with.
BUCKETS = 1_024
#: The state of a bucket is cut into parts of event time, so many in one lifetime of a reading.
PARTS = 1


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state on local disk with changes uploaded to the checkpoint, so it may outgrow memory."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _coded(texts: pd.Series, known: dict[str | None, int]) -> np.ndarray:
    """Texts as numbers; new ones are added to those known."""
    codes, distinct = pd.factorize(texts, use_na_sentinel=False)
    places = [known.setdefault(None if pd.isna(text) else text, len(known)) for text in distinct]
    return np.array(places or [0], np.int32)[codes]


def _packed(frame: pd.DataFrame, errors: dict[str | None, int], patients: dict[str | None, int]) -> np.ndarray:
    out = np.empty(len(frame), READING)
    out["who"] = _coded(frame["patient_id"], patients) if "patient_id" in frame else patients.setdefault(None, len(patients))
    out["ms"] = frame["event_ms"].fillna(NONE).astype("int64")
    out["id"] = frame["event_id"].fillna(NONE).astype("int64")
    for name, column in NUMBERS.items():
        out[name] = pd.to_numeric(frame[column]).astype("float64")
    out["anomaly"] = frame["anomaly"].astype("boolean").fillna(False).astype("int8").where(frame["anomaly"].notna(), -1)
    out["error"], bad = -1, frame["error"].notna().to_numpy()
    out["error"][bad] = _coded(frame["error"][bad], errors)
    out["previous_ms"] = out["previous_id"] = NONE
    return out


def _later(rows: np.ndarray) -> np.ndarray:
    """Places in order of (patient, time, id); of rows with all the same the last stays."""
    order = np.lexsort((rows["id"], rows["ms"], rows["who"]))
    if len(rows) < 2:
        return order
    again = np.ones(len(rows) - 1, bool)
    for name in ("who", "ms", "id"):
        sorted_ = rows[name][order]
        again &= sorted_[1:] == sorted_[:-1]
    return order[np.append(~again, True)] if again.any() else order


def _newest_good(rows: np.ndarray) -> np.ndarray:
    """Of rows in order, the place of each patient's last good one."""
    good = np.flatnonzero(rows["error"] < 0)
    who = rows["who"][good]
    return good[np.append(who[1:] != who[:-1], True)] if len(good) else good


def _find(who: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The place of each patient among rows, one for each and in order; -1 where there is none."""
    if not len(rows):
        return np.full(len(who), -1)
    place = np.minimum(np.searchsorted(rows["who"], who), len(rows) - 1)
    return np.where(rows["who"][place] == who, place, -1)


class Readings:
    """The recent readings of some patients over parts of event time, and what each is compared with.

    `parts` maps the number of a part to its readings, the texts of their errors, and the patients. New rows take their place
    in order; rows of the same patient after them, up to the next good one, are compared anew and come out again where that
    changed. Rows without a `patient_id` are all of one patient.
    """

    def __init__(self, parts: MutableMapping[int, tuple[bytes, list[str], list[str | None]]], ttl_ms: int, late_ms: int):
        self.parts, self.ttl_ms, self.late_ms = parts, ttl_ms, late_ms
        self.width = max(1, ttl_ms // PARTS)
        self.errors: dict[str | None, int] = {}
        self.patients: dict[str | None, int] = {}
        #: Parts that were read or changed, with errors and patients as numbers in the two above.
        self.held: dict[int, np.ndarray] = {}

    def _load(self, part: int) -> np.ndarray:
        if part not in self.held:
            rows = np.empty(0, READING)
            if part in self.parts:
                stored, errors, patients = self.parts[part]
                rows = np.frombuffer(stored, READING).copy()
                rows["who"] = np.array([self.patients.setdefault(x, len(self.patients)) for x in patients], np.int32)[rows["who"]]
                bad = rows["error"] >= 0
                rows["error"][bad] = np.array([self.errors.setdefault(x, len(self.errors)) for x in errors] or [0], np.int32)[rows["error"][bad]]
                rows = rows[_later(rows)]
            self.held[part] = rows
        return self.held[part]

    def _store(self, part: int) -> None:
        rows = self.held.pop(part)
        if not len(rows):
            if part in self.parts:
                del self.parts[part]
            return
        patients, errors = list(self.patients), list(self.errors)
        who, rows["who"] = np.unique(rows["who"], return_inverse=True)
        bad = rows["error"] >= 0
        error, rows["error"][bad] = np.unique(rows["error"][bad], return_inverse=True)
        self.parts[part] = (rows.tobytes(), [errors[e] for e in error], [patients[w] for w in who])

    def _near(self, part: int, earlier: np.ndarray) -> np.ndarray:
        """Of the patients' last good readings before a part, those whose part is not too far back."""
        timed = earlier[earlier["ms"] != NONE]
        return timed[(part - timed["ms"] // self.width - 1) * self.width <= self.ttl_ms]

    def _settle(self, part: int, new: np.ndarray, pending: np.ndarray, earlier: np.ndarray) -> tuple[Iterator[pd.DataFrame], np.ndarray]:
        """Put rows into a part. Returns what comes out, and the patients whose later rows may be compared with another reading.

        `pending` are such patients of the parts before, `earlier` the last good readings of these parts.
        """
        old = self._load(part)
        both = np.concatenate([old, new])
        order = _later(both)
        rows, fresh = both[order], order >= len(old)
        del both, order
        asked = np.union1d(new["who"], pending)
        at = np.flatnonzero(np.isin(rows["who"], asked))
        who = rows["who"][at]
        # For each row the place of the newest good row of its patient before it, or else -1 and that of an earlier part.
        n = np.arange(len(at))
        first = np.maximum.accumulate(np.where(np.append(True, who[1:] != who[:-1]), n, 0)) if len(at) else n
        good = np.maximum.accumulate(np.where(rows["error"][at] < 0, n, -1))
        place = np.append(-1, good[:-1])[: len(at)]
        place = np.where(place >= first, at[np.maximum(place, 0)], -1) if len(at) else place
        far = np.where(place < 0, _find(who, earlier), -1)
        previous = {}
        for name in ("ms", "id"):
            previous[name] = np.where(place >= 0, rows[name][place], NONE)
            previous[name][far >= 0] = earlier[name][far[far >= 0]]
        changed = fresh[at] | (rows["previous_ms"][at] != previous["ms"]) | (rows["previous_id"][at] != previous["id"])
        rows["previous_ms"][at], rows["previous_id"][at] = previous["ms"], previous["id"]
        self.held[part] = rows

        here, there = _newest_good(rows), old[_newest_good(old)]
        now, was = _find(asked, rows[here]), _find(asked, there)
        same = (now >= 0) == (was >= 0)
        both_there = np.flatnonzero((now >= 0) & (was >= 0))
        a, b = here[now[both_there]], was[both_there]
        same[both_there] = (rows["ms"][a] == there["ms"][b]) & (rows["id"][a] == there["id"][b]) & ~fresh[a]
        pending = asked[~same | (np.isin(asked, pending) & (now < 0))]
        return self._frames(rows, at[changed], place[changed], earlier, far[changed]), pending

    def _frames(self, rows: np.ndarray, at: np.ndarray, place: np.ndarray, earlier: np.ndarray, far: np.ndarray) -> Iterator[pd.DataFrame]:
        errors, patients = np.array([*self.errors, None], object), np.array([*self.patients, None], object)
        for start in range(0, len(at), FRAME_ROWS):
            piece = slice(start, start + FRAME_ROWS)
            r, b = rows[at[piece]], rows[place[piece]]
            outside = far[piece] >= 0
            b[outside] = earlier[far[piece][outside]]
            valid = ((place[piece] >= 0) | outside) & (r["ms"] != NONE) & (b["ms"] != NONE)
            valid[valid] = r["ms"][valid] - b["ms"][valid] <= self.ttl_ms

            def change(name: str) -> np.ndarray:
                return np.where(valid, np.abs(r[name] - np.nan_to_num(b[name], nan=0.0)), np.nan)

            def flags(values: np.ndarray, known: np.ndarray) -> pd.Series:
                return pd.Series(values > 0, dtype="boolean").where(known & (values >= 0))

            def whole(values: np.ndarray, known: np.ndarray) -> pd.Series:
                return pd.Series(np.where(known, values, 0), dtype="Int64").where(known)

            systolic = change("systolic")
            yield pd.DataFrame(
                {
                    "patient_id": patients[r["who"]],
                    "event_id": whole(r["id"], r["id"] != NONE),
                    "event_ms": whole(r["ms"], r["ms"] != NONE),
                    "risk_score": r["risk"],
                    "anomaly": flags(r["anomaly"], np.ones(len(r), bool)),
                    "error": errors[r["error"]],
                    "previous_ms": whole(b["ms"], valid),
                    "glucose_change": change("glucose"),
                    "systolic_change": systolic,
                    "diastolic_change": change("diastolic"),
                    "bp_change": systolic,
                    "previous_readmission_risk": np.where(valid, np.nan_to_num(b["risk"], nan=0.0), np.nan),
                    "previous_anomaly": flags(b["anomaly"], valid),
                }
            )

    def _expire(self, known: list[int], seen: np.ndarray, newest: dict[str | None, int]) -> Iterator[int]:
        """Drop the parts of the patients seen that lie too far before their newest time. Returns the parts that changed."""
        names = list(self.patients)
        cut = np.full(len(names), NONE)
        for who in seen.tolist():
            if names[who] in newest:
                cut[who] = newest[names[who]] - self.ttl_ms - self.late_ms
        for part in known:
            end = (part + 1) * self.width
            if end <= cut.max(initial=NONE):
                rows = self._load(part)
                # Reading a part may bring patients that were not seen.
                old = np.append(cut, np.full(len(self.patients) - len(cut), NONE))[rows["who"]] >= end
                if old.any():
                    self.held[part] = rows[~old]
                    yield part

    def add(self, frames: Iterator[pd.DataFrame], newest: dict[str | None, int] | None) -> tuple[Iterator[pd.DataFrame], dict[str | None, int]]:
        """Rows as they come, in any order, a frame at a time; returns what comes out and the newest time seen of each patient."""
        chunks = [_packed(frame, self.errors, self.patients) for frame in frames]
        new = np.concatenate(chunks) if chunks else np.empty(0, READING)
        del chunks
        new = new[np.argsort(new["ms"] // self.width, kind="stable")]
        newest = dict(newest or {})
        seen, place = np.unique(new["who"], return_inverse=True)
        times = np.full(len(seen), NONE)
        np.maximum.at(times, place, new["ms"])
        del place
        names = list(self.patients)
        for who, ms in zip(seen.tolist(), times.tolist()):
            if ms != NONE:
                newest[names[who]] = max(ms, newest.get(names[who], NONE))

        def run() -> Iterator[pd.DataFrame]:
            part_of = new["ms"] // self.width
            starts = np.flatnonzero(np.append(True, part_of[1:] != part_of[:-1])) if len(new) else []
            touched = {int(part_of[a]): new[a:b] for a, b in zip(starts, [*starts[1:], len(new)])}
            del part_of
            known = sorted({*self.parts.keys(), *touched})
            pending, earlier, reach = np.empty(0, np.int32), np.empty(0, READING), self.ttl_ms // self.width + 1
            changed = set()
            for part in known:
                earlier = self._near(part, earlier)
                if part in touched or len(pending):
                    out, pending = self._settle(part, touched.get(part, new[:0]), pending, earlier)
                    changed.add(part)
                    yield from out
                    del out
                elif not any(part < t <= part + reach for t in touched):
                    continue
                # A part may be followed by rows that are compared with it.
                rows = self._load(part)
                both = np.concatenate([earlier, rows[_newest_good(rows)]])
                order = np.argsort(both["who"], kind="stable")
                earlier = both[order][np.append(both["who"][order][1:] != both["who"][order][:-1], True)] if len(both) else both
            changed.update(self._expire(known, seen, newest))
            for part in sorted(changed):
                self._store(part)

        return run(), newest


class _Stored(MutableMapping):
    """A map in the state store."""

    def __init__(self, state: Any):
        self.state = state
        self.known = {key[0] for key in state.keys()}

    def __contains__(self, part: object) -> bool:
        return part in self.known

    def __getitem__(self, part: int) -> tuple[bytes, list[str], list[str | None]]:
        rows, errors, patients = self.state.getValue((part,))
        return bytes(rows), list(errors), list(patients)

    def __setitem__(self, part: int, value: tuple[bytes, list[str], list[str | None]]) -> None:
        self.known.add(part)
        self.state.updateValue((part,), value)

    def __delitem__(self, part: int) -> None:
        self.known.remove(part)
        self.state.removeKey((part,))

    def __iter__(self) -> Iterator[int]:
        return iter(self.known)

    def __len__(self) -> int:
        return len(self.known)


class PreviousReading(StatefulProcessor):
    """Compares each reading with the patient's newest earlier good one, whatever order they arrive in.

    A row that comes in a later batch than newer ones takes its place among them: it is compared with its true
    predecessor, and the rows after it that had been compared with an older one come out again. The key is a bucket of
    patients.
    """

    def __init__(self, ttl_ms: int, late_ms: int):
        self.ttl_ms, self.late_ms = ttl_ms, late_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        kept = self.ttl_ms + self.late_ms
        self.parts = handle.getMapState("readings", "part BIGINT", "readings BINARY, errors ARRAY<STRING>, patients ARRAY<STRING>", ttlDurationMs=kept)
        # The newest event time of each patient, and when the patient last sent a row.
        self.newest = handle.getValueState("newest", "patients ARRAY<STRING>, ms ARRAY<BIGINT>, seen_ms ARRAY<BIGINT>", ttlDurationMs=kept)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        stored = list(zip(*self.newest.get())) if self.newest.exists() else []
        # A patient is forgotten as long after its last row as its readings are.
        last = {patient: seen for patient, _, seen in stored if now - seen <= self.ttl_ms + self.late_ms}
        readings = Readings(_Stored(self.parts), self.ttl_ms, self.late_ms)
        out, newest = readings.add(rows, {patient: ms for patient, ms, _ in stored if patient in last})
        last |= dict.fromkeys(list(readings.patients), now)
        yield from out
        if newest:
            self.newest.update((list(newest), list(newest.values()), [last[patient] for patient in newest]))

    def close(self) -> None:
        pass


def patient_state_stream(scored: DataFrame, ttl_ms: int = HOUR_MS, late_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Scored events with their change since the patient's last good reading, from keyed state.

    Each row comes out once, and again when a row that arrived later turns out to lie between it and what it was
    compared with; the newest batch of an event holds (`latest_revision`). Readings are kept for `ttl_ms`, after which they
    are compared with nothing, and `late_ms` more of event time (as long again by default); rows later than that are
    compared with what is left. Patients are kept in `buckets`. In one batch a bucket's rows are held as numbers, some
    70 bytes each; for replays of whole tables use `vitals_delta`, which splits a busy patient.
    """
    slim = scored.select(
        F.pmod(F.xxhash64("patient_id"), F.lit(buckets)).alias("bucket"),
        F.col("patient_id").cast("string").alias("patient_id"),
        "event_id",
        "event_ms",
        "glucose_level",
        F.col("features.systolic_bp").alias("systolic"),
        F.col("features.diastolic_bp").alias("diastolic"),
        "risk_score",
        "anomaly",
        "error",
    )
    return slim.groupBy("bucket").transformWithStateInPandas(
        PreviousReading(ttl_ms, ttl_ms if late_ms is None else late_ms), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime"
    )

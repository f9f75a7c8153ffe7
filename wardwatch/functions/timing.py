"""Column functions over event time, arrival time and delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a row is late when it arrives more than five minutes after its event.
LATE_AFTER_MS = 300_000


def delay_ms(arrival_ms: Column, event_ms: Column) -> Column:
    return arrival_ms - event_ms


def now_ms() -> Column:
    """Processing time: one value per query, or per micro-batch in a stream."""
    return F.unix_millis(F.current_timestamp())


def is_late(delay: Column, limit_ms: int = LATE_AFTER_MS) -> Column:
    return F.coalesce(delay > limit_ms, F.lit(False))


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ms_to_seconds(ms: Column) -> Column:
    return ms / 1000.0


def seconds_to_ms(seconds: Column) -> Column:
    return seconds * 1000.0


def bytes_to_mb(size: Column) -> Column:
    return size / 1024.0 / 1024.0


def cell_start(ms: Column, width_ms: int) -> Column:
    """Start of the fixed-width cell that holds `ms`."""
    return ms - F.pmod(ms, F.lit(width_ms))


def cell_end(ms: Column, width_ms: int) -> Column:
    """End of the half-open cell `(end - width, end]` that holds `ms`."""
    return F.ceil(ms / width_ms).cast("bigint") * width_ms

"""Running values over ordered groups of any size.

A window function holds a whole group in one task, so a patient or source with a third of all rows
would decide how long the job takes. Here the rows are cut along `(group, order)` into chunks of
about equal size. Each chunk is scanned with a window of its own, and what a chunk must know about
the chunks before it comes from a small table with one row per chunk of a large group.

The cut points are literals in the plan, so every branch and every task retry puts a row into the
same chunk. Where there would be more than `MOST_LITERALS`, Spark's range partitioning cuts instead: each range is sorted and
cut by row number, and the rows are written once with the number of their chunk, so small chunks cost no task and no file each.
Cut points only shape the work; the result does not depend on
them. Groups below the chunk size are never cut, and input below it gives the plain window plan.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from wardwatch.session import stage

ROWS_PER_CHUNK = 2_000_000
MOST_LITERALS = 20_000
SAMPLES_PER_CHUNK = 20
# Where Spark cuts, a range holds this many rows at least.
ROWS_PER_RANGE = 100_000
GLOBAL_MIN_CHUNKS = 8
GLOBAL_MIN_ROWS = 1_000

FEW_EDGES = 32

CHUNK = "_chunk"
_HASHES = 1_000_000_007


@dataclass(frozen=True)
class Scan:
    """A running value: `count`, `sum`, `max` or `last` (newest non-null), with or without the row itself.

    `increase` adds up what a counter has gained, with the row itself: a value below the one before is a reset and
    counts whole; nulls are passed over. Two neighbouring pieces of a series combine from their first value, their
    last and what each gained inside.
    """

    kind: str
    value: Column | None = None
    inclusive: bool = True


@dataclass(frozen=True)
class Splits:
    """Cut points along `(group, order)`: the first key of each chunk but the first."""

    group: tuple[str, ...]
    order: tuple[str, ...]
    schema: T.StructType
    edges: tuple[tuple, ...] = ()
    #: Ranges that Spark cuts, where cut points would be too many for the plan, and the rows of a chunk inside a range.
    ranges: int = 0
    range_chunk: int = ROWS_PER_CHUNK

    @property
    def keys(self) -> list[str]:
        return [*self.group, *self.order]

    def _array(self, rows: Sequence[tuple], width: int) -> Column:
        """Keys as one typed literal: kept as text where JSON has no form for a type, and cast back."""
        fields = self.schema.fields[:width]
        names = [f.name for f in fields]
        text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
        plain = T.StructType([T.StructField(f.name, T.StringType() if _as_text(f.dataType) else f.dataType) for f in fields])
        parsed = F.from_json(F.lit(text), T.ArrayType(plain))
        if plain == T.StructType(fields):
            return parsed
        return F.transform(parsed, lambda e: F.struct(*[_typed(e[f.name], f.dataType).alias(f.name) for f in fields]))

    def _literal(self) -> Column:
        return self._array(self.edges, len(self.keys))

    def hot(self) -> Column:
        """True for rows of the groups that are cut; there are at most as many as cut points."""
        if not self.group:
            return F.lit(True)
        owners = list(dict.fromkeys(e[: len(self.group)] for e in self.edges))
        if len(self.group) == 1 and not _as_text(self.schema.fields[0].dataType):
            named = F.col(self.group[0]).isin([o[0] for o in owners if o[0] is not None])
            missing = F.col(self.group[0]).isNull() if (None,) in owners else F.lit(False)
            return F.coalesce(named, F.lit(False)) | missing
        owned = F.struct(*[F.col(c) for c in self.group])
        return F.array_contains(self._array(owners, len(self.group)), owned)

    def chunk(self) -> Column:
        """Number of cut points up to the row's key; 0 in groups that are not cut.

        A few cut points are compared one by one in generated code, many by binary search.
        """
        if not self.edges:
            return F.lit(0)
        key = F.struct(*[F.col(c) for c in self.keys])
        edges = self._literal()
        if len(self.edges) <= FEW_EDGES:
            place = F.lit(0)
            for i in range(len(self.edges)):
                place = place + (edges[i] <= key).cast("int")
        else:
            steps = [2**i for i in reversed(range(len(self.edges).bit_length()))]
            place = F.aggregate(
                F.array(*[F.lit(s) for s in steps]),
                F.lit(0),
                lambda low, step: F.when(F.get(edges, low + step - 1) <= key, low + step).otherwise(low),
            )
        return F.when(self.hot(), place).otherwise(F.lit(0))


def _as_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType, T.BinaryType))


def _text_of(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.hex(name)
    return F.col(name).cast("string") if _as_text(kind) else F.col(name)


def _typed(text: Column, kind: T.DataType) -> Column:
    return F.unhex(text) if isinstance(kind, T.BinaryType) else text.cast(kind) if _as_text(kind) else text


def plan_splits(df: DataFrame, group: Sequence[str], order: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> Splits:
    """Find cut points from a sample of keys whose size depends on the number of chunks only.

    The driver sees at most `SAMPLES_PER_CHUNK * MOST_LITERALS` keys, or as many as Spark's range partitioning takes.
    """
    keys = df.select(*group, *order)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in keys.schema.fields])
    none = Splits(tuple(group), tuple(order), schema)
    hashed = F.pmod(F.xxhash64(*[F.col(c) for c in keys.columns]), F.lit(_HASHES))
    if group:
        # The share to sample follows from the chunk size alone, so one pass counts and samples.
        seen = Observation()
        counted = keys.observe(seen, F.count(F.lit(1)).alias("rows"))
        found = stage(counted.where(hashed < math.ceil(min(1.0, SAMPLES_PER_CHUNK / rows_per_chunk) * _HASHES)), "range-sample")
        rows = seen.get["rows"]
    else:
        rows = keys.count()
        if rows > GLOBAL_MIN_ROWS:
            rows_per_chunk = min(rows_per_chunk, math.ceil(rows / GLOBAL_MIN_CHUNKS))
        found = keys.where(hashed < math.ceil(min(1.0, SAMPLES_PER_CHUNK / rows_per_chunk) * _HASHES))
    chunks = math.ceil(rows / rows_per_chunk)
    if chunks < 2:
        return none
    if chunks > MOST_LITERALS:
        return replace(none, ranges=math.ceil(rows / max(rows_per_chunk, ROWS_PER_RANGE)), range_chunk=rows_per_chunk)
    sample = found.orderBy(*keys.columns).select(*[_text_of(f.name, f.dataType).alias(f.name) for f in schema.fields]).collect()
    every = max(1, round(len(sample) / chunks))
    cuts = [tuple(sample[i]) for i in range(every, len(sample), every)]
    if group:
        width = len(group)
        owners = [c[:width] for c in cuts]
        cuts = [c for i, c in enumerate(cuts) if owners[i] in (owners[i - 1] if i else None, *owners[i + 1 : i + 2])]
    return Splits(tuple(group), tuple(order), schema, tuple(dict.fromkeys(cuts)))


def _gain(value: Column, before: Column) -> Column:
    """What a counter gained between two of its values."""
    return F.when(value.isNotNull() & before.isNotNull(), F.when(value >= before, value - before).otherwise(value))


def _running(scan: Scan, window: WindowSpec, gain: str = "") -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, 0 if scan.inclusive else -1)
    if scan.kind == "count":
        return F.count(F.lit(1)).over(frame)
    if scan.kind == "last":
        return F.last(scan.value, ignorenulls=True).over(frame)
    if scan.kind == "increase":
        return F.coalesce(F.sum(gain).over(frame), F.lit(0.0))
    return {"sum": F.sum, "max": F.max}[scan.kind](scan.value).over(frame)


def _windowed(df: DataFrame, scans: Mapping[str, Scan], window: WindowSpec) -> DataFrame:
    """Running values over a window; increases leave the gain of each row, and whether a value has come by then."""
    before, upto = (window.rowsBetween(Window.unboundedPreceding, end) for end in (-1, 0))
    gains = {}
    for n, s in scans.items():
        if s.kind == "increase":
            gains[f"_gain_{n}"] = _gain(s.value, F.last(s.value, ignorenulls=True).over(before))
            gains[f"_come_{n}"] = F.count(s.value).over(upto) > 0
    return (df.withColumns(gains) if gains else df).withColumns({n: _running(s, window, f"_gain_{n}") for n, s in scans.items()})


def _chunk_total(name: str, scan: Scan, order: Sequence[str]) -> Column:
    if scan.kind == "count":
        return F.count(F.lit(1))
    if scan.kind in ("last", "increase"):
        place = F.when(scan.value.isNotNull(), F.struct(*[F.col(c) for c in order]))
        newest = F.max_by(scan.value, place)
        if scan.kind == "last":
            return newest
        return F.struct(F.min_by(scan.value, place).alias("first"), newest.alias("last"), F.coalesce(F.sum(f"_gain_{name}"), F.lit(0.0)).alias("gain"))
    return {"sum": F.sum, "max": F.max}[scan.kind](scan.value)


def _carries(totals: DataFrame, scans: Mapping[str, Scan], window: WindowSpec) -> DataFrame:
    """What each chunk must know about those before it, `_carry_` and the name."""
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    joints, carries = {}, {}
    for name, scan in scans.items():
        total = F.col(f"_total_{name}")
        if scan.kind == "increase":
            # The step from the piece before into this one counts from the first value of this one on.
            joints[f"_joint_{name}"] = _gain(total["first"], F.last(total["last"], ignorenulls=True).over(before))
            inside = F.sum(total["gain"]).over(before)
            steps = F.sum(f"_joint_{name}").over(before)
            base = F.coalesce(inside, F.lit(0.0)) + F.coalesce(steps, F.lit(0.0))
            carries[f"_carry_{name}"] = F.struct(base.alias("base"), F.coalesce(f"_joint_{name}", F.lit(0.0)).alias("joint"))
        else:
            kind = "sum" if scan.kind == "count" else scan.kind
            carries[f"_carry_{name}"] = _running(Scan(kind, total, inclusive=False), window)
    return (totals.withColumns(joints) if joints else totals).withColumns(carries)


def _combine(name: str, scan: Scan, own: Column, carry: Column) -> Column:
    if scan.kind == "increase":
        joint = F.when(F.col(f"_come_{name}"), carry["joint"]).otherwise(F.lit(0.0))
        return own + F.coalesce(carry["base"] + joint, F.lit(0.0))
    if scan.kind in ("count", "sum"):
        return F.coalesce(own + carry, own, carry)
    if scan.kind == "max":
        return F.greatest(own, carry)
    return F.coalesce(own, carry)


def ordered_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    scans: Mapping[str, Scan],
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
    splits: Splits | None = None,
) -> DataFrame:
    """Add one running column per scan. `order` must be unique within a group.

    `rows_per_chunk=None` is for series whose length has a bound of its own, such as one row per
    minute; no cut points are looked for then.
    """
    if splits is None and rows_per_chunk is not None:
        splits = plan_splits(df, group, order, rows_per_chunk)
    if splits is None or not (splits.edges or splits.ranges):
        window = Window.partitionBy(*group).orderBy(*order)
        return _windowed(df, scans, window).select(*df.columns, *scans)

    if splits.ranges:
        ranged = df.repartitionByRange(splits.ranges, *group, *order).sortWithinPartitions(*group, *order)
        # The number of the range is in the high bits, that of the row inside it in the low 33.
        place = F.monotonically_increasing_id()
        row = place.bitwiseAND(F.lit(2**33 - 1))
        ranged = ranged.withColumn(CHUNK, place - row + F.floor(row / splits.range_chunk))
        # Written once, so that all branches and retries see the same chunks.
        chunked, cut = stage(ranged, "ranged-rows"), F.lit(True)
    else:
        chunked, cut = df.withColumn(CHUNK, splits.chunk()), splits.hot()
    own = _windowed(chunked, scans, Window.partitionBy(*group, CHUNK).orderBy(*order))
    if any(s.kind == "increase" for s in scans.values()):
        # The totals need the gains, so the scan is written instead of made twice.
        own = chunked = stage(own, "ordered-scan")

    totals = chunked.where(cut).groupBy(*group, CHUNK).agg(*[_chunk_total(n, s, order).alias(f"_total_{n}") for n, s in scans.items()])
    carry = _carries(totals, scans, Window.partitionBy(*group).orderBy(CHUNK)).select(
        *[F.col(c).alias(f"_key_{c}") for c in (*group, CHUNK)], *[F.col(f"_carry_{name}") for name in scans]
    )
    on = F.lit(True)
    for c in (*group, CHUNK):
        on = on & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    # With literal cut points there are at most two rows for each; ranges also list the small groups, and Spark decides.
    joined = own.join(carry if splits.ranges else F.broadcast(carry), on, "left")
    return joined.select(
        *df.columns,
        *[_combine(name, s, F.col(name), F.col(f"_carry_{name}")).alias(name) for name, s in scans.items()],
    )


def settle(df: DataFrame, splits: Splits | None, name: str) -> DataFrame:
    """Stage the result of one scan before the next one reads it; small input goes on as it is.

    A split scan reads its input twice, so scans on top of each other would double the work at
    every level.
    """
    return stage(df, name) if splits is not None and (splits.edges or splits.ranges) else df

"""Keyed tables that grow with a stream, kept as runs that are merged in the background of its batches.

A batch writes its own rows as one run, sorted by the hash of the key, whatever the size of the table. Runs of
like size lie on one level. Where as many as `RUNS` of a level overlap, they are merged into one on the level
above, a range of hashes at a time: a merged range becomes a segment of its own, and the runs below it
keep the rest. So large runs are in pieces, which split as the table grows. What a batch may merge follows
the rows it brought, with credit kept for the next, so the bytes it writes follow the batch and the logarithm of
the table, and no batch ever rewrites the table.

A manifest per batch lists the segments and the range of each that still counts. A replayed batch starts from the manifest
before its own and writes the same again. Reading merges the rows of all segments; a reader with
some keys opens only the segments whose ranges hold them.

The manifest has an entry per `segment_rows` rows of the table, some hundred bytes each.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardwatch.sinks.snapshots import VERSIONS_KEPT, folder, gone

Merge = Callable[[DataFrame], DataFrame]

HASH, SEGMENT = "key_hash", "segment"
LOWEST, HIGHEST = -(2**63), 2**63 - 1
RUNS = 8
#: Rows of the smallest level; each level holds runs up to `RUNS` times larger than the one below.
LEVEL_ROWS = 1_000
SEGMENT_ROWS = 200_000
#: A batch may merge so many rows for each row it brings and each level of the table.
MERGED_PER_ROW = 2
#: Keys are looked up in the manifest by the first bits of their hashes.
PREFIX_BITS = 12


@dataclass(frozen=True)
class Segment:
    """A folder of rows, of which those with hashes from `low` to `high` count; `rows` is their number, nearly.

    Where a range was merged out of the middle, the folder is listed twice. `whole` means that all its rows count.
    """

    name: str
    level: int
    low: int
    high: int
    rows: int
    whole: bool = True

    def within(self, low: int, high: int) -> float:
        """Rows between two hashes, as hashes are even."""
        low, high = max(low, self.low), min(high, self.high)
        return 0.0 if high < low else self.rows * (high - low + 1) / (self.high - self.low + 1)

    def without(self, low: int, high: int) -> list[Segment]:
        """What is left when a range is taken out."""
        if high < self.low or low > self.high:
            return [self]
        ends = [(self.low, low - 1), (high + 1, self.high)]
        return [replace(self, low=a, high=b, rows=round(self.within(a, b)), whole=False) for a, b in ends if a <= b]


@dataclass(frozen=True)
class Manifest:
    segments: tuple[Segment, ...] = ()
    credit: int = 0

    def text(self) -> str:
        return json.dumps({"credit": self.credit, "segments": [asdict(s) for s in self.segments]})

    @staticmethod
    def of(text: str) -> Manifest:
        held = json.loads(text)
        return Manifest(tuple(Segment(**s) for s in held["segments"]), held["credit"])


def level_of(rows: int) -> int:
    level = 0
    while rows > LEVEL_ROWS * RUNS**level:
        level += 1
    return level


def crowded_range(segments: list[Segment], runs: int = RUNS) -> tuple[int, int] | None:
    """The lowest range of hashes in which at least `runs` segments of a level overlap."""
    turns: dict[int, int] = {}
    for s in segments:
        turns[s.low] = turns.get(s.low, 0) + 1
        turns[s.high + 1] = turns.get(s.high + 1, 0) - 1
    depth, start = 0, None
    for at in sorted(turns):
        depth += turns[at]
        if start is None and depth >= runs:
            start = at
        elif start is not None and depth < runs:
            return start, at - 1
    return None


def bite(segments: list[Segment], low: int, high: int, most: int) -> int:
    """The end of a range from `low` that holds about `most` rows, at most `high`."""
    rows = sum(s.within(low, high) for s in segments)
    return high if rows <= most else low + max(0, int((high - low + 1) * most / rows) - 1)


@dataclass(frozen=True)
class KeyedTable:
    """A table of `schema` under `path`; `merge` turns rows of several runs into the rows that the table has.

    `merge` looks at the rows of one key only, and it makes no difference in how many steps it is applied.
    """

    path: str
    schema: str
    key: str
    merge: Merge
    segment_rows: int = SEGMENT_ROWS
    runs: int = RUNS
    keep: int = VERSIONS_KEPT

    def versions(self, spark: SparkSession) -> list[int]:
        """The batches whose manifests are kept, oldest first."""
        fs, target = folder(spark, f"{self.path}/manifest")
        if not fs.exists(target):
            return []
        names = [entry.getPath().getName() for entry in fs.listStatus(target)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] != ".")

    def manifest(self, spark: SparkSession, before: int | None = None) -> Manifest:
        """The newest manifest, or the newest before a batch.

        Where only later ones are left, as after a restart from an old checkpoint, that is an error.
        """
        there = self.versions(spark)
        found = [v for v in there if before is None or v < before]
        if not found:
            if there and before and min(there) > 0:
                raise gone(self.path, before, there)
            return Manifest()
        fs, file = folder(spark, f"{self.path}/manifest/{found[-1]}.json")
        stream = fs.open(file)
        try:
            return Manifest.of(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_manifest(self, spark: SparkSession, batch_id: int, manifest: Manifest) -> None:
        fs, file = folder(spark, f"{self.path}/manifest/{batch_id}.json")
        _, draft = folder(spark, f"{self.path}/manifest/.{batch_id}.draft")
        stream = fs.create(draft, True)
        stream.write(bytearray(manifest.text().encode()))
        stream.close()
        if fs.exists(file):
            fs.delete(file, False)
        if not fs.rename(draft, file):
            raise OSError(f"could not write {file.toString()}")

    def _rows(self, spark: SparkSession, segments: list[Segment]) -> DataFrame:
        """The rows of segments as far as they count, not merged."""
        if not segments:
            return spark.createDataFrame([], f"{self.schema}, {HASH} BIGINT")
        paths = sorted({f"{self.path}/{SEGMENT}={s.name}" for s in segments})
        raw = spark.read.schema(f"{self.schema}, {HASH} BIGINT, {SEGMENT} STRING").option("basePath", self.path).parquet(*paths)
        # Few are cut: those at the edge of what was merged last on their level.
        cut: dict[str, list[Segment]] = {}
        for s in segments:
            if not s.whole:
                cut.setdefault(s.name, []).append(s)
        for name, parts in sorted(cut.items()):
            raw = raw.where(reduce(or_, [F.col(HASH).between(s.low, s.high) for s in parts], F.col(SEGMENT) != name))
        return raw.drop(SEGMENT)

    def read(self, spark: SparkSession, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table as of the newest batch, or before one; with `keys` only their rows.

        Of `keys` the driver sees the first bits of their hashes, at most 4,096 numbers.
        """
        segments = list(self.manifest(spark, before).segments)
        if keys is None:
            return self.merge(self._rows(spark, segments).drop(HASH))
        keys = keys.select(self.key).distinct()
        shift = 64 - PREFIX_BITS
        hit = sorted(r[0] for r in keys.select(F.shiftright(F.xxhash64(self.key), shift)).distinct().collect())
        held = [s for s in segments if any(s.low >> shift <= p <= s.high >> shift for p in hit)]
        return self.merge(self._rows(spark, held).drop(HASH).join(keys, self.key, "left_semi"))

    def _write(self, spark: SparkSession, rows: DataFrame, name: str, low: int, high: int, level: int | None = None) -> Segment:
        seen = Observation()
        counted = rows.withColumn(HASH, F.xxhash64(self.key)).sortWithinPartitions(HASH).observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{self.path}/{SEGMENT}={name}")
        n = seen.get["rows"]
        return Segment(name, level_of(n) if level is None else level, low, high, n)

    def update(self, spark: SparkSession, batch_id: int, rows: DataFrame, live: Column | None = None) -> None:
        """Add the rows of a batch, then merge as much as the batch has credit for.

        `live` leaves rows out that have expired, here and wherever they are merged.
        """

        def kept(df: DataFrame) -> DataFrame:
            merged = self.merge(df)
            return merged if live is None else merged.where(live)

        prior = self.manifest(spark, batch_id)
        new = self._write(spark, kept(rows), f"{batch_id}_0", LOWEST, HIGHEST)
        segments = [*prior.segments, new] if new.rows else list(prior.segments)
        levels = max((s.level for s in segments), default=0) + 1
        credit = prior.credit + MERGED_PER_ROW * levels * max(new.rows, 1)
        number = 0
        while credit > 0:
            step = self._next(segments)
            if step is None:
                # Credit is not hoarded: it never pays for more than one large segment.
                credit = min(credit, self.segment_rows)
                break
            level, low, high = step
            parts = [s for s in segments if s.level == level and s.low <= high and s.high >= low]
            cost = max(1, round(sum(s.within(low, high) for s in parts)))
            if cost > credit:
                break
            number += 1
            source = self._rows(spark, parts).where(F.col(HASH).between(low, high)).drop(HASH)
            merged = self._write(spark, kept(source), f"{batch_id}_{number}", low, high, level + 1)
            credit -= cost
            left = [r for s in segments for r in (s.without(low, high) if s.level == level else [s])]
            segments = [*left, *([merged] if merged.rows else [])]
        self._write_manifest(spark, batch_id, Manifest(tuple(segments), max(credit, 0)))
        self._clean(spark, batch_id)

    def _next(self, segments: list[Segment]) -> tuple[int, int, int] | None:
        """The level and range of hashes to merge next: the lowest range of the lowest crowded level."""
        for level in sorted({s.level for s in segments}):
            own = [s for s in segments if s.level == level]
            found = crowded_range(own, self.runs)
            if found:
                return level, found[0], bite(own, *found, self.segment_rows)
        return None

    def _clean(self, spark: SparkSession, batch_id: int) -> None:
        """Drop manifests too old to be read again, and folders that no kept manifest names."""
        there = [v for v in self.versions(spark) if v <= batch_id]
        old, kept = there[: -self.keep], there[-self.keep :]
        fs, root = folder(spark, self.path)
        for v in old:
            fs.delete(folder(spark, f"{self.path}/manifest/{v}.json")[1], False)
        if not old:
            return
        used = {s.name for v in kept for s in self.manifest(spark, v + 1).segments}
        for entry in fs.listStatus(root):
            name = entry.getPath().getName()
            if name.startswith(f"{SEGMENT}=") and name.partition("=")[2] not in used:
                fs.delete(entry.getPath(), True)

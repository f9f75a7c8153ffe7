"""Repair of conversation structure: the cheapest edits that make role initials read (s?(ua)+)?, as a lightest derivation.

An item says how many rows are read and where in the pattern the repaired turns stand. Each edit deduces one item
from another and adds to its value, a pair of cost and audit (the initials of the edits so far). That function is
superior: its value is never below what it is made from, and it keeps the order of two values of one item, as audits of one
cost that read the same rows never start one with the other. So Knuth's agenda may pop items by (cost, audit), and
the first goal item it pops is the answer.

Rows are dealt by range of (conversation, turn) and sorted. A conversation that lies whole within a task, and is of
ordinary length, is repaired there. Of the others (at most two a task but for long ones), each task sends on its rows in
pieces of `PIECE`: whether a text was seen before is settled by its first piece, each piece is derived from every
state it may be entered in, and the few values of each piece, which compose like matrices, are folded along the
conversation. Only the digest of the repaired text, which is by its nature taken from first to last, reads the rows of
a conversation in one task, a row at a time.

Defined results: nulls in role and text are one space, as are those of the damaged key; rows are ordered by turn (nulls
first), role and text. A null conv_id is a conversation of its own. Repeated rows are rows. An empty
table gives none. Differences of turns are taken modulo 2**64. Texts of any length are read one at a time. Further
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import bounded_batches
from wardwatch.session import ship, stage

ship(__name__)

#: Rows of a long conversation that are derived at once, and the rows and bytes that make one long.
PIECE, LONG_ROWS, LONG_BYTES = 512, 2_048, 4 << 20
#: Where the repaired turns stand: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
GOALS = (EMPTY, ASSISTANT)
#: Fixed by the contract: costs of edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The role that an inserted or reroled turn takes in each state, and where each turn leads.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: b"user", ASSISTANT: b"assistant"}
LEGAL = {b"su", b"ua", b"au"}

Value = tuple[int, str]


class Row(NamedTuple):
    """What the derivation needs of a row: its role's initial, whether it must go, whether it is cut short."""

    initial: bytes
    gone: bool
    cut: bool


def _kept(state: int, initial: bytes) -> int | None:
    if initial == b"u":
        return USER if state != USER else None
    if initial == b"a":
        return ASSISTANT if state == USER else None
    return SYSTEM if initial == b"s" and state == EMPTY else None


def agenda(rows: list[Row], entry: int, open_end: bool) -> dict[int, Value]:
    """The lightest value of each state after the last row, from a state before the first.

    With `open_end` the conversation goes on: all states are wanted, and turns are inserted before a row only.
    Otherwise the first goal item that is popped ends the derivation.
    """
    final: set[tuple[int, int]] = set()
    ends: dict[int, Value] = {}
    heap: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in final:
            continue
        final.add((at, state))
        last = at == len(rows)
        if last:
            ends[state] = (cost, audit)
            if not open_end and state in GOALS:
                return ends
        if not (last and open_end):
            heapq.heappush(heap, (cost + INSERT, audit + "I", at, NEXT[state]))
        if last:
            continue
        row = rows[at]
        heapq.heappush(heap, (cost + DELETE, audit + "D", at + 1, state))
        if not row.gone:
            cut = TRUNCATED if row.cut else 0
            heapq.heappush(heap, (cost + REROLE + cut, audit + "R", at + 1, NEXT[state]))
            kept = _kept(state, row.initial)
            if kept is not None:
                heapq.heappush(heap, (cost + cut, audit + "K", at + 1, kept))
    return ends


class Track:
    """Follows an audit through the rows: the repaired turn of each edit."""

    def __init__(self) -> None:
        self.state = EMPTY

    def turn(self, edit: str, role: bytes, text: bytes) -> tuple[bytes, bytes]:
        if edit == "K":
            self.state = _kept(self.state, role[:1])
            return role, text
        self.state = NEXT[self.state]
        return NAMES[self.state], text if edit == "R" else b""


class Digest:
    """The hash of `role:text` lines, fed a turn at a time."""

    def __init__(self) -> None:
        self.sha, self.first = hashlib.sha256(), True

    def add(self, role: bytes, text: bytes) -> None:
        if not self.first:
            self.sha.update(b"\n")
        self.first = False
        for part in (role, b":", text):
            self.sha.update(part)


@dataclass
class Facts:
    """What is counted of neighbouring rows; two that follow each other add up."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: bytes | None = None
    last: bytes | None = None

    def __add__(self, other: Facts) -> Facts:
        if self.first is None:
            return other
        if other.first is None:
            return self
        joint = self.high is not None and self.high == other.low
        return Facts(
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in LEGAL),
            self.turns + other.turns - joint,
            self.low if self.low is not None else other.low,
            other.high if other.high is not None else self.high,
            self.first,
            other.last,
        )

    def gaps(self) -> int:
        return 0 if self.low is None else _long(self.high - self.low + 1 - self.turns)


def _long(x: int) -> int:
    return (x + 2**63) % 2**64 - 2**63


def facts_of(turn: int | None, initial: bytes, fault: str) -> Facts:
    counts = {name: int(fault == name) for name in ("blank", "duplicate", "truncated")}
    return Facts(**counts, turns=int(turn is not None), low=turn, high=turn, first=initial, last=initial)


def digest_of(role: bytes, text: bytes) -> bytes:
    h = hashlib.blake2b(len(role).to_bytes(8, "big"), digest_size=16)
    h.update(role)
    h.update(text)
    return h.digest()


def fault_of(text: bytes, seen: bool) -> str:
    """bytes.rstrip() takes off exactly the six characters that count as blank."""
    end = text.rstrip()
    if not end:
        return "blank"
    if seen:
        return "duplicate"
    return "" if end[-1:] in b".!?" else "truncated"


FACTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
REPORT = f"conv_id KEY, gaps bigint, {FACTS}, cost bigint, audit string, repaired_sha256 string"
_SENT = "part int, at bigint, turn bigint, role binary, text binary, digest binary, fault string"


@dataclass
class _Run:
    """The rows of one conversation in one task, as far as they are held."""

    key: Any
    edge: bool
    rows: list[tuple] = field(default_factory=list)
    seen: set[bytes] = field(default_factory=set)
    size: int = 0
    sent: int = 0


def _report(key: Any, facts: Facts, value: Value, sha: str) -> dict[str, Any]:
    counts = {name: getattr(facts, name) for name in ("blank", "duplicate", "truncated", "illegal")}
    return {"conv_id": key, "gaps": facts.gaps(), **counts, "cost": value[0], "audit": value[1], "repaired_sha256": sha}


def repaired(rows: list[tuple]) -> tuple[Facts, Value, list[tuple[bytes, bytes]]]:
    """A whole conversation of `(turn, role, text, digest, fault)`: its facts, its edits, its repaired turns."""
    facts, slim = Facts(), []
    for turn, role, _, _, fault in rows:
        facts = facts + facts_of(turn, role[:1], fault)
        slim.append(Row(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    value = next(v for s, v in agenda(slim, EMPTY, False).items() if s in GOALS)
    track, left, turns = Track(), iter(rows), []
    for edit in value[1]:
        _, role, text, _, _ = (None, b"", b"", None, None) if edit == "I" else next(left)
        if edit != "D":
            turns.append(track.turn(edit, role, text))
    return facts, value, turns


def _finish(run: _Run) -> dict[str, Any]:
    facts, value, turns = repaired(run.rows)
    sha = Digest()
    for role, text in turns:
        sha.add(role, text)
    return _report(run.key, facts, value, sha.sha.hexdigest())


def _deal(long_rows: int, long_bytes: int, schema: pa.Schema):
    """Repair what lies whole in a task; send on, with their faults as far as the task sees, the rows of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held = 0
        now: _Run | None = None

        def send(run: _Run) -> None:
            nonlocal held
            for turn, role, text, digest, fault in run.rows:
                out.append({"conv_id": run.key, "part": part, "at": run.sent, "turn": turn, "role": role, "text": text, "digest": digest, "fault": fault})
                run.sent += 1
                held += len(text)
            run.rows.clear()
            run.edge, run.size = True, 0
            if not run.sent:
                # A conversation without a row still has a result.
                out.append({"conv_id": run.key, "part": part, "at": -1})

        def batch() -> pa.RecordBatch:
            nonlocal held
            done = pa.RecordBatch.from_pylist(out, schema)
            out.clear()
            held = 0
            return done

        for group in batches:
            columns = [group.column(i).to_pylist() for i in range(5)]
            for key, lost, turn, role, text in zip(*columns):
                if now is None or key != now.key:
                    if now is not None:
                        if now.edge:
                            send(now)
                        else:
                            out.append(_finish(now))
                    now = _Run(key, edge=now is None)
                if not lost:
                    digest = digest_of(role, text)
                    now.rows.append((turn, role, text, digest, fault_of(text, digest in now.seen)))
                    now.seen.add(digest)
                    now.size += len(text)
                    if len(now.rows) >= long_rows or now.size >= long_bytes:
                        send(now)
                if len(out) >= 1_000 or held >= long_bytes:
                    yield batch()
        if now is not None:
            send(now)
        if out:
            yield batch()

    return run


def _null_safe(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _settled(rows: DataFrame) -> DataFrame:
    """Sent rows with their faults: of a text that several tasks took for new, only the first stays so.

    Rows that their task already knows to be blank or repeated do not take part, so a text has one row per task here.
    """
    open_rows = F.coalesce(F.col("at") >= 0, F.lit(False)) & ~F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(True))
    fresh = rows.where(open_rows)
    first = fresh.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(F.struct("part", "at")).alias("first"), F.count("*").alias("n"))
    again = first.where("n > 1").select("c", "d", "first")
    later = F.col("first").isNotNull() & (F.struct("part", "at") != F.col("first"))
    joined = fresh.join(again, _null_safe("conv_id", "c") & _null_safe("digest", "d"), "left")
    judged = joined.withColumn("fault", F.when(later, F.lit("duplicate")).otherwise(F.col("fault"))).drop("c", "d", "first")
    return judged.unionByName(rows.where(~open_rows))


def _pieces(rows: DataFrame, piece: int, kind: str) -> DataFrame:
    """Each piece of a conversation: its facts and its value from each state to each other."""
    fields = ", ".join(f"{name} bigint" for name in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high"))
    schema = f"conv_id {kind}, part int, piece bigint, {fields}, first binary, last binary, ways array<struct<entry: int, state: int, cost: bigint, audit: string>>"
    slim = rows.where("at >= 0").select("conv_id", "part", F.expr(f"at div {piece}").alias("piece"), "at", "turn", F.substring("role", 1, 1).alias("initial"), "fault")

    def derive(key: tuple, table: pa.Table) -> pa.Table:
        facts, own = Facts(), []
        for row in table.sort_by("at").to_pylist():
            facts = facts + facts_of(row["turn"], row["initial"], row["fault"])
            own.append(Row(row["initial"], row["fault"] in ("blank", "duplicate"), row["fault"] == "truncated"))
        ways = [{"entry": e, "state": s, "cost": c, "audit": a} for e in STATES for s, (c, a) in agenda(own, e, True).items()]
        line = {"conv_id": key[0].as_py(), "part": key[1].as_py(), "piece": key[2].as_py(), **vars(facts), "ways": ways}
        return pa.Table.from_pylist([line], arrow)

    arrow = _arrow(rows.sparkSession, schema)
    return slim.groupBy("conv_id", "part", "piece").applyInArrow(derive, schema)


def _arrow(spark: Any, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def fold(pieces: Iterable[dict]) -> tuple[Facts, Value]:
    """The facts and the lightest value of a conversation from its pieces in order.

    What the audits of all states begin with is settled, and put away.
    """
    facts, settled = Facts(), []
    live: dict[int, Value] = {EMPTY: (0, "")}
    names = Facts.__dataclass_fields__
    for piece in pieces:
        facts = facts + Facts(**{name: piece[name] for name in names})
        best: dict[int, Value] = {}
        for way in piece["ways"]:
            if way["entry"] in live:
                cost, audit = live[way["entry"]]
                value = (cost + way["cost"], audit + way["audit"])
                if way["state"] not in best or value < best[way["state"]]:
                    best[way["state"]] = value
        common = os.path.commonprefix([audit for _, audit in best.values()])
        settled.append(common)
        live = {state: (cost, audit[len(common) :]) for state, (cost, audit) in best.items()}
    ends = {EMPTY: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
    cost, audit = min((cost + INSERT * len(ends[s]), audit + ends[s]) for s, (cost, audit) in live.items())
    return facts, (cost, "".join(settled) + audit)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[dict]]]:
    """Neighbouring rows of one conversation, a row at a time."""
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead = next(rows, None)
    while ahead is not None:
        key = ahead["conv_id"]

        def own() -> Iterator[dict]:
            nonlocal ahead
            while ahead is not None and ahead["conv_id"] == key:
                row, ahead = ahead, next(rows, None)
                yield row

        one = own()
        yield key, one
        for _ in one:
            pass


def _folded(pieces: DataFrame, schema: pa.Schema, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own in _runs(batches):
            yield pa.RecordBatch.from_pylist([_report(key, *fold(own), "")], schema)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(run, ddl)


def _turns(rows: DataFrame, reports: DataFrame, ddl: str) -> DataFrame:
    """The repaired turns of sent conversations: `conv_id, position, edit, role, text`, a row at a time."""
    audits = reports.select("conv_id", F.lit(-2).alias("part"), F.lit(-2).cast("long").alias("at"), F.lit(b"").alias("role"), F.col("audit").cast("binary").alias("text"))
    both = audits.unionByName(rows.where("at >= 0").select("conv_id", "part", "at", "role", "text"))
    schema = _arrow(rows.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own in _runs(batches):
            audit, track, out, size, position = next(own)["text"].decode(), Track(), [], 0, 0
            for edit in audit:
                row = {"role": b"", "text": b""} if edit == "I" else next(own)
                if edit == "D":
                    continue
                role, text = track.turn(edit, row["role"], row["text"])
                out.append({"conv_id": key, "position": position, "edit": edit, "role": role, "text": text})
                position, size = position + 1, size + len(text)
                if size > LONG_BYTES or len(out) >= 1_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at").mapInArrow(run, ddl)


def _digests(turns: DataFrame, ddl: str) -> DataFrame:
    """The hash of each conversation's repaired turns; they come in order, so nothing moves."""
    schema = _arrow(turns.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own in _runs(batches):
            sha = Digest()
            for row in own:
                sha.add(row["role"], row["text"])
            yield pa.RecordBatch.from_pylist([{"c": key, "sha": sha.sha.hexdigest()}], schema)

    return turns.mapInArrow(run, ddl)


def dealt(rows: DataFrame, kind: str, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """Rows by range, sorted: reports of conversations that lie whole in a task, and the rows of the others."""
    ddl = f"{REPORT.replace('KEY', kind)}, {_SENT}"
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    start = [F.substring(F.col(c).cast("string"), 1, 64) for c in ("role", "text")]
    ranged = rows.repartitionByRange(*order, *start).sortWithinPartitions(*order, "role", "text")
    return ranged.mapInArrow(_deal(long_rows, long_bytes, _arrow(rows.sparkSession, ddl)), ddl)


def repair(rows: DataFrame, piece: int = PIECE, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """The report of each conversation: gaps, faults, cost and audit of its repair, digest of its repaired turns.

    `rows` has `conv_id, turn, role, text`; where it has `lost`, rows marked so are not there but their conversation is.
    """
    kind = dict(rows.dtypes)["conv_id"]
    lost = F.col("lost") if "lost" in rows.columns else F.lit(False)
    binary = [F.coalesce(F.col(c), F.lit(" ")).cast("binary").alias(c) for c in ("role", "text")]
    slim = bounded_batches(rows).select("conv_id", lost.alias("lost"), F.col("turn").cast("long").alias("turn"), *binary)
    ddl = REPORT.replace("KEY", kind)
    names = [name.split()[0] for name in ddl.split(", ")]
    both = stage(dealt(slim, kind, long_rows, long_bytes), "conversations-dealt")
    whole = both.where("audit IS NOT NULL").select(names)
    sent = both.where("audit IS NULL").select("conv_id", "part", "at", "turn", "role", "text", "digest", "fault")
    settled = stage(_settled(sent), "conversations-settled")
    reports = stage(_folded(_pieces(settled, piece, kind), _arrow(rows.sparkSession, ddl), ddl), "conversations-folded")
    turns = _turns(settled, reports, f"conv_id {kind}, position bigint, edit string, role binary, text binary")
    shas = _digests(turns, f"c {kind}, sha string")
    nothing = hashlib.sha256().hexdigest()
    # Conversations that lost all rows, or keep no turn, have no line among the digests.
    keys = settled.select("conv_id").distinct().select(F.col("conv_id").alias("k"))
    full = keys.join(reports.drop("repaired_sha256"), _null_safe("k", "conv_id"), "left").join(shas, _null_safe("k", "c"), "left")
    zeros = [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in names[1:7]]
    split = full.select(F.col("k").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"))
    return whole.unionByName(split)


def damage(rows: DataFrame) -> DataFrame:
    """Faults by crc32 of `conv_id:turn`: dropped (marked `lost`), emptied, unfinished, repeated, spoken by the wrong side."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    slim = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), fault.alias("fault"))
    twice = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text = F.when(F.col("fault").isin(0, 1), F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    return slim.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == 0).alias("lost"), twice.alias("copy")).drop("copy")

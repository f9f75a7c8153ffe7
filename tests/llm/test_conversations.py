import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from wardwatch.llm import conversations
from wardwatch.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = out[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain(rows):
    """One conversation by forward tables of all pairs (cost, audit) per state, no agenda."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANKS)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {"": "u", "s": "u", "u": "a", "a": "u"}

    def widen(table):
        for _ in range(4):
            for state, (cost, audit) in list(table.items()):
                to, value = step[state], (cost + 2, audit + "I")
                table[to] = min(table.get(to, value), value)
        return table

    table = widen({"": (0, "")})
    for (_, role, _), fault in zip(rows, faults):
        new = {}
        for state, (cost, audit) in table.items():
            ways = [(state, cost + 3, audit + "D")]
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                ways.append((step[state], cost + 2 + extra, audit + "R"))
                first = role[:1]
                if first and (first == step[state] or (first == "s" and state == "")):
                    ways.append((first, cost + extra, audit + "K"))
            for to, *value in ways:
                new[to] = min(new.get(to, tuple(value)), tuple(value))
        table = widen(new)
    cost, audit = min(table[s] for s in ("", "a") if s in table)
    lines, left, state = [], iter(rows), ""
    for edit in audit:
        row = next(left) if edit != "I" else (None, "", "")
        if edit == "D":
            continue
        state = row[1][:1] if edit == "K" else step[state]
        name = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[state]
        lines.append(f"{name}:{row[2]}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    return sorted([(conv, *plain(own)) for conv, own in damaged(rows).items()], key=str)


def got(df, **limits):
    return sorted([tuple(r) for r in conversations.repair(conversations.damage(df), **limits).select(COLUMNS).collect()], key=str)


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(11)
    texts = ["Yes.", "no", "Why?", "", " \n", None, "Ünï. ", "a\nb!", "x" * 5_000]
    roles = ["user", "assistant", "system", "tool", None, "", "u", "User"]
    rows = [(c, t, rng.choice(roles[:3] if c % 2 else roles), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(500, t % 1_300 if t % 7 else None, rng.choice(roles[:3]), f"{rng.choice('abc')} {t % 900}{rng.choice(['.', ''])}") for t in range(1_500)]
    rows += [(None, rng.choice([None, 1, 2, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(40)]
    rows += [(600, None, "user", "Hi."), (600, None, "user", "Hi."), (601, -(2**62), "user", "Hi."), (601, 2**62, "assistant", "Ho.")]
    rows += [(700 + n, 0, "user", "All gone.") for n in range(60)]
    return rows


def test_given_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert got(df) == expected(rows_of(df))
    assert "op11_conversation_repair" in QUERIES


@pytest.mark.parametrize("limits", [{}, {"piece": 3, "long_rows": 2}, {"piece": 40, "long_bytes": 1}])
def test_odd_rows_whole_and_in_pieces(spark, odd, limits):
    df = spark.createDataFrame(odd, SCHEMA).repartition(3)
    crowded = df.selectExpr("*", "'x' as lost2", "1 as at", "2 as part", "'f' as fault", "3 as piece", "4 as copy", "5 as digest")
    assert got(crowded if limits else df, **limits) == expected(odd)


def test_empty(spark, odd):
    df = spark.createDataFrame(odd, SCHEMA)
    assert got(df.limit(0)) == []


def test_agenda_pops_the_lightest():
    rng = random.Random(2)
    for _ in range(400):
        rows = [(i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["", "a.", "b", f"{i}."])) for i in range(rng.randint(0, 12))]
        full = [(t, r.encode(), x.encode(), b"", "") for t, r, x in rows]
        seen, marked = set(), []
        for t, r, x, d, _ in full:
            marked.append((t, r, x, d, conversations.fault_of(x, (r, x) in seen)))
            seen.add((r, x))
        _, value, turns = conversations.repaired(marked)
        want = plain(rows)
        assert value == want[5:7]
        assert hashlib.sha256(b"\n".join(r + b":" + x for r, x in turns)).hexdigest() == want[7]
        # Pieces fold to the same.
        size = rng.randint(1, 4)
        pieces = []
        for at in range(0, len(marked), size):
            facts, slim = conversations.Facts(), []
            for t, r, x, d, f in marked[at : at + size]:
                facts = facts + conversations.facts_of(t, r[:1], f)
                slim.append(conversations.Row(r[:1], f in ("blank", "duplicate"), f == "truncated"))
            ways = [{"entry": e, "state": s, "cost": c, "audit": a} for e in conversations.STATES for s, (c, a) in conversations.agenda(slim, e, True).items()]
            pieces.append({**vars(facts), "ways": ways})
        facts, folded = conversations.fold(pieces)
        assert folded == want[5:7] and facts.gaps() == want[0] and (facts.blank, facts.duplicate, facts.truncated, facts.illegal) == want[1:5]

"""Personal data by anchors: an Aho-Corasick automaton finds at-signs, schemes, digit joints and cues in one pass over
a text, and a local parser expands each anchor to the boundaries of an address, number or account and validates it.

Null texts are empty and have no spans; so have texts without an anchor. Texts are taken whole, whatever their length:
each parser remembers how far it has read, so a text is read a constant number of times. Positions are code points;
in ill-formed UTF-8 each bad sequence counts as one. Equal rows give equal results, one per row; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import bounded_batches, map_arrow
from wardwatch.session import ship

ship(__name__)

#: In the order of the results. The first four have base patterns; the last two are found by cues only.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE_KINDS = KINDS[:4]
FOUND = "array<struct<kind: string, start: bigint, stop: bigint, base: boolean>>"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))

DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOCAL = LETTERS + DIGITS + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
JOINED = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIALLED = re.compile(r"[ ().0-9-]*")
AUTHORITY = re.compile(r"[^\s/?#\"'<>]*")
#: Words that announce an account, and what may stand between them and its number.
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "ssn")
BETWEEN = re.compile(r"(?:\s{0,3}(?:no\.?|number|nr\.?))?\s{0,3}[:=#]?\s{0,3}", re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![ -]?[0-9])")
#: Bounds of the address standards: a local part, a label, a whole name, a scheme.
LONGEST_LOCAL, LONGEST_LABEL, LONGEST_NAME, LONGEST_SCHEME = 64, 63, 253, 20


class Span(NamedTuple):
    kind: str
    start: int
    stop: int
    base: bool


def automaton() -> ahocorasick.Automaton:
    """Each anchor with the parser that it wakes and its length."""
    out = ahocorasick.Automaton()
    out.add_word("@", ("at", 1))
    out.add_word("://", ("scheme", 3))
    for a in DIGITS:
        out.add_word("+" + a, ("plus", 2))
        for b in DIGITS:
            out.add_word(f"{a}.{b}", ("dot", 3))
            for joint in ("", " ", "-"):
                out.add_word(a + joint + b, ("digits", 2 + len(joint)))
    for cue in ("tel:", "Tel:", "TEL:"):
        out.add_word(cue, ("tel", 4))
    for cue in ACCOUNT_CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            out.add_word(form, ("account", len(form)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    turned = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


class Parsers:
    """The parsers of one text. Anchors come in the order in which they end, so what is read is never read again."""

    def __init__(self, text: str):
        self.text = text
        self.found: list[Span] = []
        self.email_end = self.at_end = self.dot_end = self.digits_end = 0

    def at(self, at: int, length: int) -> None:
        text, low = self.text, max(self.email_end, self.at_end)
        self.at_end = at + 1
        before = text[low:at]
        start = at - len(before) + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            self.email_end = domain.end()
            self.found.append(Span("email", start, domain.end(), True))
        else:
            self._wide_email(at, low)

    def _wide_email(self, at: int, low: int) -> None:
        """An address with letters of any script, where the base pattern finds none."""
        text, start, stop = self.text, at, at + 1
        while start > low and at - start <= LONGEST_LOCAL and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        while stop < len(text) and stop - at <= LONGEST_NAME and (text[stop].isalnum() or text[stop] in ".-"):
            stop += 1
        name = text[at + 1 : stop].rstrip(".-")
        labels = name.split(".")
        sound = all(0 < len(part) <= LONGEST_LABEL and part[0] != "-" and part[-1] != "-" for part in labels)
        if 0 < at - start <= LONGEST_LOCAL and len(name) < LONGEST_NAME and len(labels) > 1 and sound and len(labels[-1]) > 1 and labels[-1].isalpha():
            self.found.append(Span("email", start, at + 1 + len(name), False))

    def dot(self, at: int, length: int) -> None:
        if at < self.dot_end:
            return
        before = self.text[self.dot_end : at]
        start = at - len(before) + len(before.rstrip(DIGITS))
        chain = DOTTED.match(self.text, start)
        self.dot_end = chain.end()
        parts = chain.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            stop = start + sum(len(p) + 1 for p in parts[i : i + 4]) - 1
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                self.found.append(Span("ip", start, stop, True))
            start = stop + 1

    def digits(self, at: int, length: int) -> None:
        if at < self.digits_end:
            return
        chain = JOINED.match(self.text, at)
        self.digits_end = chain.end()
        digits = chain.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            self.found.append(Span("card", at, chain.end(), True))

    def _dialled(self, start: int, first: int) -> tuple[int, int]:
        """The end of a run of digits and marks that starts at `first`, without the marks at its end, and its digits."""
        run = DIALLED.match(self.text, first).group().rstrip(" ().-")
        return first + len(run), sum(c in DIGITS for c in run)

    def plus(self, at: int, length: int) -> None:
        stop, digits = self._dialled(at, at + 1)
        if stop - at > 3 and 9 <= digits <= 15:
            self.found.append(Span("phone", at, stop, True))

    def tel(self, at: int, length: int) -> None:
        start = at + length
        while start < min(len(self.text), at + length + 3) and self.text[start] == " ":
            start += 1
        stop, digits = self._dialled(start, start)
        if 7 <= digits <= 15 and self.text[start] in DIGITS + "(":
            self.found.append(Span("phone", start, stop, False))

    def scheme(self, at: int, length: int) -> None:
        text, start = self.text, at
        while start and at - start < LONGEST_SCHEME and text[start - 1] in LETTERS + DIGITS + "+.-":
            start -= 1
        while start < at and text[start] not in LETTERS:
            start += 1
        if start == at:
            return
        authority = AUTHORITY.match(text, at + length)
        user, sign, host = authority.group().rpartition("@")
        if sign and user and host:
            self.found.append(Span("url", start, authority.end(), False))
        if host.startswith("[") and "]" in host:
            inside = host[1 : host.index("]")]
            try:
                ipaddress.IPv6Address(inside)
            except ValueError:
                return
            first = authority.end() - len(host) + 1
            self.found.append(Span("ip", first, first + len(inside), False))

    def account(self, at: int, length: int) -> None:
        text = self.text
        if at and text[at - 1].isalnum():
            return
        first = BETWEEN.match(text, at + length).end()
        if first == at + length:
            return
        number = IBAN.match(text, first)
        if number:
            # What follows in capitals may belong to the next word: give up groups from the end.
            value = number.group()
            while value and not iban_ok(value.replace(" ", "")):
                value = value.rpartition(" ")[0]
            if value:
                self.found.append(Span("account", first, first + len(value), False))
            return
        number = SSN.match(text, first) or ACCOUNT.match(text, first)
        if number:
            self.found.append(Span("account", first, number.end(), False))


_ORDER = {kind: i for i, kind in enumerate(KINDS)}


def find(text: str, anchors: ahocorasick.Automaton) -> list[Span]:
    """The spans of a text by kind, then start; a base span stands before an added one."""
    parsers = Parsers(text)
    for last, (parser, length) in anchors.iter(text):
        getattr(parsers, parser)(last - length + 1, length)
    base = {(s.kind, s.start, s.stop) for s in parsers.found if s.base}
    kept = [s for s in parsers.found if s.base or (s.kind, s.start, s.stop) not in base]
    return sorted(set(kept), key=lambda s: (_ORDER[s.kind], s.start, s.stop, not s.base))


def mask(text: str, spans: list[Span]) -> str:
    """The text with each run of spans as the name of the one that starts first."""
    out, end = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.stop)):
        if span.start >= end:
            out += [text[end : span.start], f"<{span.kind.upper()}>"]
        end = max(end, span.stop)
    return "".join([*out, text[end:]])


def personal_data(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), masked: bool = False) -> DataFrame:
    """Columns `keep`, and `found`: the spans of the text by kind, then start; on demand `masked`, the text without them.

    A null text is empty. `base` marks the spans of the four base patterns; the others are added by the method.
    """
    slim = bounded_batches(df).select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.col(text).cast("binary").alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column("content").to_pylist()]
            spans = [find(t, anchors) for t in texts]
            columns = [batch.column("kept"), pa.array([[s._asdict() for s in each] for each in spans], _FOUND)]
            if masked:
                columns.append(pa.array([mask(t, each) for t, each in zip(texts, spans)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["kept", "found", "masked"][: len(columns)])

    schema = f"kept {slim.schema['kept'].dataType.simpleString()}, found {FOUND}" + (", masked string" if masked else "")
    return map_arrow(slim, run, schema).select("kept.*", "found", *(["masked"] if masked else []))


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans per kind, the digest of the base spans, and all spans as text."""
    base = F.filter("found", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(kind) for kind in BASE_KINDS], F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("found")).alias("spans"))

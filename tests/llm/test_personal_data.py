import hashlib
import random
import re
import time

import pytest

from wardwatch.llm import personal_data
from wardwatch.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def by_pattern(text):
    return [(kind, m.start(), m.end()) for kind, pattern in BASE.items() for m in re.finditer(pattern, text) if _holds(kind, m.group())]


def base_of(text, anchors=None):
    found = personal_data.find(text, anchors or personal_data.automaton())
    return [(s.kind, s.start, s.stop) for s in found if s.base]


def test_base_spans_equal_the_patterns_on_noise():
    rng, anchors = random.Random(3), personal_data.automaton()
    pieces = list("@@@..+- ()%_aZé0123456789") + ["4111 1111 1111 1111", "10.20.30.40", "a@b.c", "+1 (212) 555-0100", "://", "tel:", "IBAN ", "1.2", "0-0"]
    for _ in range(6_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))
        assert base_of(text, anchors) == by_pattern(text), text


def test_added_spans():
    def added(text):
        return [(s.kind, text[s.start : s.stop]) for s in personal_data.find(text, personal_data.automaton()) if not s.base]

    assert added("mail jörg@müller.de now") == [("email", "jörg@müller.de")]
    assert added("see https://bob:pw@example.com/x and http://example.org/") == [("url", "https://bob:pw@example.com")]
    assert added("at http://[2001:db8::1]:80/") == [("ip", "2001:db8::1")]
    assert added("tel: 030 1234567.") == [("phone", "030 1234567")]
    assert added("IBAN: DE89 3704 0044 0532 0130 00 PAID") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert added("IBAN: DE88 3704 0044 0532 0130 00") == []
    assert added("SSN 123-45-6789, account no. 00123456") == [("account", "123-45-6789"), ("account", "00123456")]
    assert added("the accounts of 12345678 people, tel:, iban, a@b, x@y.1") == []


def _long(n):
    return "7" * n + "." * 10 + "1." * n + "@" * 100 + "a" * n + "@b.c " + "+1" * n


def test_long_texts_are_read_once():
    # The plain patterns go back over long runs again and again, so only the short form is held against them.
    assert base_of(_long(500)) == by_pattern(_long(500))
    start = time.perf_counter()
    found = base_of(_long(300_000))
    assert time.perf_counter() - start < 20
    assert [kind for kind, _, _ in found[:1]] == ["email"] and len(found) == 1 + 300_000 // 4


def test_query_against_patterns(spark, sf_dir, edge_docs, crowded, no_docs):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), edge_docs, crowded):
        rows = personal_data.digest(personal_data.personal_data(docs)).collect()
        want = sorted(((r.doc_id, by_pattern(r.text or "")) for r in docs.select("doc_id", "text").collect()), key=str)
        names = [",".join(f"{k}:{a}:{b}" for k, a, b in spans) for _, spans in want]
        shas = sorted((str(d), hashlib.sha256(n.encode()).hexdigest()) for (d, _), n in zip(want, names))
        assert sorted((str(r.doc_id), r.base_sha256) for r in rows) == shas
        counts = sorted((str(d), *[sum(k == kind for k, _, _ in spans) for kind in personal_data.BASE_KINDS]) for d, spans in want)
        assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows) == counts
        for r in rows:
            assert r.spans.count(":") == 2 * len([s for s in r.spans.split(",") if s])
    assert personal_data.digest(personal_data.personal_data(no_docs)).count() == 0
    assert "op13_personal_data" in QUERIES


def test_masked_and_ill_formed(spark):
    df = spark.createDataFrame([(1, "to a@b.co or 10.0.0.1!"), (2, None), (3, "")], "doc_id int, text string")
    got = {r.doc_id: r.masked for r in personal_data.personal_data(df, masked=True).collect()}
    assert got == {1: "to <EMAIL> or <IP>!", 2: "", 3: ""}
    bad = spark.sql("select 1 doc_id, cast(concat(x'ff', cast(' a@b.co' as binary)) as string) text")
    (row,) = personal_data.personal_data(bad).collect()
    assert [(s.kind, s.start, s.stop) for s in row.found] == [("email", 2, 8)]


@pytest.mark.parametrize("text, spans", [("", []), ("a@b.c@d.e", [("email", 0, 5)]), ("1.2.3.4.5.6.7.8", [("ip", 0, 7), ("ip", 8, 15)]), ("+12", [])])
def test_by_hand(text, spans):
    assert base_of(text) == spans == by_pattern(text)

"""Substring and suffix dedup against brute force, with the limits of the machinery set small as well."""

import collections
import hashlib

import numpy as np
import pytest

from wardwatch.llm import substring_dedup, suffix_dedup, windows


def by_words(rows, width=35):
    seen = collections.Counter()
    words = [(d, (t or "").encode().split()) for d, t, *_ in rows]
    for _, w in words:
        seen.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    out = []
    for d, w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = True
        kept = b" ".join(w[i] for i in range(len(w)) if not gone[i])
        out.append((d, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return out


def by_bytes(rows, width=50):
    last = 1 << 63
    first = {}
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    for d, b in texts:
        for i in range(len(b) - width + 1):
            s = b[i : i + width]
            first[s] = min(first.get(s, last), last if d is None else d)
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < (last if d is None else d):
                gone[i : i + width] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def same(got, wanted):
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, wanted))


@pytest.fixture(params=["plain", "small"])
def limits(request, monkeypatch):
    """Small limits: many chunks, blocks and pieces, and most anchors at full length."""
    if request.param == "small":
        for name, value in {"CHUNK_BYTES": 2_000, "BLOCK_BYTES": 3_000, "LONGEST_RUN": 7, "PIECE": 500, "HOT": 3}.items():
            monkeypatch.setattr(windows, name, value)


def test_words(crowded, edge_rows, limits):
    got = substring_dedup.cut_words(crowded)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    same(got.drop("kept").collect(), by_words(edge_rows))


def test_bytes(crowded, edge_rows, limits):
    same(suffix_dedup.cut_bytes(crowded).collect(), by_bytes(edge_rows))


def test_documents_keep_their_columns(crowded):
    got = suffix_dedup.cut_documents(crowded)
    assert got.dtypes == crowded.dtypes
    rows = got.collect()
    assert all((r.text is None) == (r.doc_id == 1) and r.score == "x" for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_empty_tables(no_docs):
    assert substring_dedup.cut_words(no_docs).collect() == []
    assert suffix_dedup.cut_bytes(no_docs).collect() == []


@pytest.mark.parametrize("kind", ["random", "repetitive", "nested"])
def test_suffix_array_and_matching_statistics(kind):
    rng = np.random.default_rng(5)
    text = {"random": rng.integers(1, 5, 400), "repetitive": np.tile([1, 2, 1, 3], 90), "nested": np.r_[np.ones(150, int), 2, np.ones(149, int)]}[kind]
    text = np.r_[text, 0].astype(np.int16)
    order = suffix_dedup.suffix_array(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = suffix_dedup.RunIndex(text, order)
    pattern = np.r_[text[30:90], text[:20], text[200:260]].astype(np.int64)
    place, length = index.stream(pattern, np.array([0, len(pattern)]))
    whole = text.tolist()
    for i in range(len(pattern)):
        n = int(length[i])
        assert pattern[i : i + n].tolist() == whole[place[i] : place[i] + n]
        # The longest match, as far as lengths are told apart.
        if n < suffix_dedup.COMPARED and i + n < len(pattern):
            longer = pattern[i : i + n + 1].tolist()
            assert not any(whole[k : k + n + 1] == longer for k in range(len(whole) - n))

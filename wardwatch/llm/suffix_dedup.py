"""Remove bytes that lie in a string which also starts in an earlier document, by run-length indexes.

Segments that share an anchor (`windows.py`) meet in blocks of bounded size. Each block is made one text with
its Burrows-Wheeler transform, which repetitive text turns into few runs. Kept are a character and a first row
for each run, and the text's place at both ends of it. The segments are streamed through it from their last
byte to their first: where the run of the current row has the wanted byte, the match grows by one; elsewhere
it goes on from the end of the nearest run with that byte, above or below, whichever shares more with the
match. The length so kept is the matching statistic. Where it reaches the window, the window is a long
match, and the first document of all its places decides whether it is removed.

Defined results: a null or empty text has no bytes; ids order documents, and rows of one id are one document,
so repeated rows do not remove each other; a null id comes after all others; matches never cross rows. The
operator's `text` drops the rest of a character that was cut through. Further columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import lockstep, map_arrow, prefix_hash, span_hash, texts_of
from wardwatch.llm.windows import LAST_ID, Kind, Symbols, covered, matched, removed_spans, with_ids
from wardwatch.session import ship

ship(__name__)

KIND = Kind(window=50, gram=20, by_word=False, first_doc=True)
#: How far two places of the text are compared; longer than a window, so that what is longer is long enough.
COMPARED = 64


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of a text of symbols below 512 in the order of their suffixes, by doubling; only ties are sorted again."""
    n, packed = len(text), np.zeros(len(text), np.int64)
    padded = np.r_[text.astype(np.int64), np.zeros(7, np.int64)]
    for k in range(7):
        packed = (packed << 9) | padded[k : k + n]
    order = np.argsort(packed)
    first = np.r_[True, packed[order][1:] != packed[order][:-1]]
    depth, rank = 7, np.empty(n + 1, np.int64)
    rank[n] = -1
    starts = np.flatnonzero(first)
    rank[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    tied = np.flatnonzero(np.repeat(np.diff(np.r_[starts, n]) > 1, np.diff(np.r_[starts, n])))
    while len(tied):
        sub = order[tied]
        own, after = rank[sub], rank[np.minimum(sub + depth, n)]
        moved = np.argsort(own * (n + 1) + after + 1)
        sub, own, after = sub[moved], own[moved], after[moved]
        order[tied] = sub
        new = np.r_[True, (own[1:] != own[:-1]) | (after[1:] != after[:-1])]
        begin = np.flatnonzero(new)
        size = np.diff(np.r_[begin, len(sub)])
        rank[sub] = np.repeat(tied[begin], size)
        tied = tied[np.repeat(size > 1, size)]
        depth *= 2
    return order


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a text, with the text's places at the ends of runs."""

    def __init__(self, text: np.ndarray, order: np.ndarray):
        last = text[order - 1].astype(np.int64)  # the symbol before each suffix, in row order
        begin = np.flatnonzero(np.r_[True, last[1:] != last[:-1]])
        size = np.diff(np.r_[begin, len(last)])
        self.text, self.begin, self.symbol = text, begin, last[begin]
        self.run_of = np.repeat(np.arange(len(begin), dtype=np.int32), size)
        self.high_row, self.low_place, self.high_place = begin + size - 1, order[begin], order[begin + size - 1]
        # Row that the first row of a run steps to: smaller symbols, then equal ones in runs before.
        by_symbol = np.argsort(self.symbol, kind="stable")
        self.step = np.empty(len(begin), np.int64)
        self.step[by_symbol] = np.cumsum(size[by_symbol]) - size[by_symbol]
        self.by_symbol = self.symbol[by_symbol] * len(begin) + by_symbol  # in order

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols, up to COMPARED, that the suffixes at a and b have in common."""
        n, reach = len(self.text), np.arange(COMPARED)
        left = self.text[np.minimum(a[:, None] + reach, n - 1)]
        right = self.text[np.minimum(b[:, None] + reach, n - 1)]
        differ = left != right
        return np.where(differ.any(1), differ.argmax(1), COMPARED)

    def stream(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of patterns, one after the other in `symbols`: a place and a length for each symbol."""
        runs = len(self.begin)
        place, length = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
        counts = np.diff(at)
        order, live = lockstep(counts)
        end = at[1:][order] - 1
        row, here, size = (np.zeros(len(order), np.int64) for _ in range(3))
        here[:] = self.low_place[0]
        for t, n in enumerate(live):
            want = symbols[end[:n] - t]
            run = self.run_of[row[:n]]
            miss = np.flatnonzero(self.symbol[run] != want)
            if len(miss):
                c, j, now = want[miss], run[miss], here[miss]
                above = np.searchsorted(self.by_symbol, c * runs + j)
                later, before = self.by_symbol[np.minimum(above, runs - 1)], self.by_symbol[np.maximum(above - 1, 0)]
                has_later, has_before = (later // runs == c) & (above < runs), (before // runs == c) & (above > 0)
                later, before = later % runs, before % runs
                shared_l = np.where(has_later, self._shared(self.low_place[later], now), -1)
                shared_b = np.where(has_before, self._shared(self.high_place[before], now), -1)
                down = shared_l > shared_b
                run[miss] = np.where(down, later, before)
                row[miss] = np.where(down, self.begin[later], self.high_row[before])
                here[miss] = np.where(down, self.low_place[later], self.high_place[before])
                size[miss] = np.minimum(size[miss], np.maximum(shared_l, shared_b))
                unknown = miss[~(has_later | has_before)]
            row[:n] = self.step[run] + row[:n] - self.begin[run]
            here[:n] -= 1
            size[:n] += 1
            if len(miss) and len(unknown):
                row[unknown], here[unknown], size[unknown] = 0, self.low_place[0], 0
            place[end[:n] - t], length[end[:n] - t] = here[:n], size[:n]
        return place, length


def index_values(s: Symbols, n: np.ndarray, first_doc: np.ndarray, kind: Kind) -> np.ndarray:
    """The first document of each window of the texts of `s`; `first_doc` is that of each whole text."""
    counts = np.diff(s.at)
    # One text of all, each followed by 0, which no pattern holds.
    text = np.zeros(len(s.blob) + len(counts), np.int16)
    owner = np.repeat(np.arange(len(counts)), counts)
    text[np.arange(len(s.blob)) + owner] = s.blob.astype(np.int16) + 1
    order = suffix_array(text)
    index = RunIndex(text, order)

    row = np.repeat(np.arange(len(n)), n)
    begin = s.at[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    # The first document of each place of the text at which a window starts: rows of equal windows are neighbours.
    window_at = np.zeros(len(text), bool)
    window_at[begin + row] = True
    rows = order[window_at[order]]
    sums = prefix_hash(text.astype(np.uint64))
    hashed = span_hash(sums, rows, rows + kind.window)
    new = np.flatnonzero(np.r_[True, hashed[1:] != hashed[:-1]][: len(rows)])
    doc_at = np.full(len(text), LAST_ID, np.int64)
    doc_at[begin + row] = first_doc[row]
    if len(rows):
        least = np.minimum.reduceat(doc_at[rows], new)
        doc_at[rows] = np.repeat(least, np.diff(np.r_[new, len(rows)]))

    place, length = index.stream(s.blob.astype(np.int64) + 1, s.at)
    value = np.full(len(row), LAST_ID, np.int64)
    long = length[begin] >= kind.window
    value[long] = doc_at[place[begin[long]]]
    return value


def _cut(rows: DataFrame, kind: Kind, columns: dict[str, str], make) -> DataFrame:
    """The rows of `with_ids` (`_row` may be beside them) with columns made of text and removed bytes."""
    joined = matched(rows, removed_spans(rows.select("doc_id", "text_hash", "text"), kind, index_values, "suffix"))
    keep = [c for c in joined.columns if c not in ("text", "spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"bigint": pa.int64(), "string": pa.string()}
        for batch in batches:
            texts, spans = texts_of(batch.column(batch.schema.names.index("text"))), batch.column(batch.schema.names.index("spans")).to_pylist()
            out = []
            for text, own in zip(texts, spans):
                gone = covered(own, len(text), kind)
                out.append(make(text, gone, np.frombuffer(text, np.uint8)[~gone].tobytes() if own else text))
            made = [pa.array(c, kinds[t]) for c, t in zip(zip(*out), columns.values())]
            yield pa.record_batch([*(batch.column(batch.schema.names.index(c)) for c in keep), *made], [*keep, *columns])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select(*keep).schema] + [f"{c} {t}" for c, t in columns.items()])
    return map_arrow(joined, run, schema)


def cut_bytes(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256` of each row."""

    def make(text: bytes, gone: np.ndarray, kept: bytes) -> tuple:
        runs = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        return len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()

    columns = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    cut = _cut(with_ids(docs), kind, columns, make)
    return cut.select(F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"), *columns)


def cut_documents(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """The documents with `text` as it is kept, and `n_chars`, where there is one, as its length. A null text stays null."""
    made = _cut(with_ids(docs, row=True), kind, {"kept": "string"}, lambda text, gone, kept: (kept.decode(errors="ignore"),))
    length = F.col("_row.length")
    kept = {"text": F.when(length.isNotNull(), F.col("kept"))}
    if "n_chars" in docs.columns:
        same = F.length("kept") == length
        kept["n_chars"] = F.when(same | length.isNull(), F.col("_row.c_n_chars")).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType)
    return made.select(*[kept.get(c, F.col("_row")[f"c_{c}"]).alias(c) for c in docs.columns])

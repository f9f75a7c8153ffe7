"""Remove words that lie in a window of words which occurs elsewhere too, by suffix trees.

Suffixes are split into groups of a bounded size by prefix, and a tree is built over each group by itself.
The prefix that splits is the anchor of a window (`windows.py`), a run of words within the first ones of a
suffix, so suffixes that follow each other travel as one piece of text; groups that are still too large are
split by the whole window, the longest prefix that matters. In a group, nodes are opened level by level:
the suffixes of a node are divided by their next words, and a suffix alone in its node is a leaf and done.
What is left at the depth of a window are the deep internal nodes; the suffixes below one are the places
of one maximal repeat, and every word under such a window goes.

Defined results: a null or empty text has no words; texts shorter than a window lose nothing; rows of one id
and text repeat each other and are both cut; a window within one document that comes twice counts; rows of a
null id count as documents after all others and keep their null. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import map_arrow, mix64, prefix_hash, span_hash, texts_of
from wardwatch.llm.windows import LAST_ID, Kind, Symbols, covered, matched, removed_spans, with_ids
from wardwatch.session import ship

ship(__name__)

KIND = Kind(window=35, gram=9, by_word=True, first_doc=False)
#: Depths at which nodes are opened.
STEP = 8


def tree_values(s: Symbols, n: np.ndarray, weight: np.ndarray, kind: Kind) -> np.ndarray:
    """How often each window of the texts of `s` occurs; a text stands for `weight` equal ones."""
    row = np.repeat(np.arange(len(n)), n)
    begin = s.at[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    value = weight[row].astype(np.int64)
    words = prefix_hash(mix64(s.hashes))
    suffix, node, depth = np.arange(len(row)), np.zeros(len(row), np.int64), 0
    while depth < kind.window and len(suffix):
        deeper = min(depth + STEP, kind.window)
        at = begin[suffix]
        edge = span_hash(words, at + depth, at + deeper)
        order = np.lexsort((edge, node))
        suffix, node, edge = suffix[order], node[order], edge[order]
        first = np.r_[True, (node[1:] != node[:-1]) | (edge[1:] != edge[:-1])]
        size = np.diff(np.r_[np.flatnonzero(first), len(suffix)])
        child = np.cumsum(first) - 1
        inner = size[child] > 1  # one suffix alone is a leaf
        suffix, node, depth = suffix[inner], child[inner], deeper
    if len(suffix):
        _, place = np.unique(node, return_inverse=True)
        value[suffix] = np.bincount(place, weight[row[suffix]]).astype(np.int64)[place]
    return value


def cut_words(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """`doc_id, n_words, n_removed, kept_sha256, kept` of each row; kept is the text of the remaining words."""
    rows = with_ids(docs)
    joined = matched(rows, removed_spans(rows, kind, tree_values, "substring"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(texts_of(batch.column(2)), batch.column(3).to_pylist()):
                words = text.split()
                gone = covered(spans, len(words), kind)
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)] if spans else words)
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.record_batch([batch.column(0), *columns], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    cut = map_arrow(joined, run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return cut.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST_ID)))

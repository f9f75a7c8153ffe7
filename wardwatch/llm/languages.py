"""Language of texts and of the spans within them.

A word's score for a language is the sum of the log probabilities of its byte trigrams, with the ends of
the word in them. The script of its letters, told by ranges of code points, leaves those languages that
are written in it. A Viterbi path over the words of a text, with a penalty for each change of language,
labels spans; the language with most bytes in words is the text's, and its share is the score. The paths
of many texts are followed at once, a word of each at a time.

The model is fitted on a bounded sample of labelled rows, chosen by hash of the id (`SAMPLE` rows are
expected): trigram counts and scripts, summed in the cluster; its size depends on the languages only.

Defined results: a null text, or one without a letter, is `und` with score 0; without any labelled row all
texts are `und`; equal shares go to the language first by code point; rows of one id are judged each by
its own text. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import NOT_LETTER, bounded_batches, groups_of, join_texts, lockstep, lower_texts, map_arrow, words_in
from wardwatch.session import ship

ship(__name__)

UNKNOWN = "und"
SAMPLE = 20_000
FEATURES = 1 << 16
PENALTY = 12.0
#: What a word in a script that a language is not written in costs it, and the share of words that makes a script one of its own.
FOREIGN, OWN_SHARE = 40.0, 0.02

# Scripts by the first byte of a character in UTF-8.
OTHER, LATIN, GREEK, CYRILLIC, HEBREW, ARABIC, INDIC, KANA, HAN, HANGUL = range(10)
SCRIPT_OF_LEAD = {
    LATIN: [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)],
    GREEK: [0xCE, 0xCF],
    CYRILLIC: [0xD0, 0xD1, 0xD2, 0xD3],
    HEBREW: [0xD7],
    ARABIC: [0xD8, 0xD9, 0xDA, 0xDB],
    INDIC: [0xE0],
    KANA: [0xE3],
    HAN: [0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9],
    HANGUL: [0xEA, 0xEB, 0xEC, 0xED],
}
SCRIPTS = 10
_SCRIPT = np.zeros(256, np.uint8)
for _script, _leads in SCRIPT_OF_LEAD.items():
    _SCRIPT[_leads] = _script
_LETTER = np.where(NOT_LETTER, 32, np.arange(256)).astype(np.uint32)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # feature by language
    own_script: np.ndarray  # script by language


def _features(blob: np.ndarray) -> np.ndarray:
    """The hashed trigram around each byte; bytes that are no letter count as the end of a word."""
    letters = _LETTER[blob]
    around = np.full(len(letters) + 2, 32, np.uint32)
    around[1:-1] = letters
    x = around[:-2] * np.uint32(0x9E3779B1) + around[1:-1] * np.uint32(0x85EBCA77) + around[2:] * np.uint32(0xC2B2AE3D)
    return ((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)


def _words(blob: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    start, stop = words_in(blob, NOT_LETTER)
    if not len(start):
        return start, stop, start, start
    edges = np.c_[start, stop].ravel()
    script = np.maximum.reduceat(_SCRIPT[blob], edges[:-1] if edges[-1] >= len(blob) else edges)[::2]
    return start, stop, script, edges


def fit(docs: DataFrame, trained: Column, sample: int = SAMPLE) -> Model | None:
    """Learn from rows with `trained` and a language; None without any."""
    known = docs.where(trained & F.col("lang").isNotNull() & F.col("text").isNotNull())
    per_language = dict(known.groupBy("lang").count().orderBy("lang").collect())  # a row per language
    if not per_language:
        return None
    languages, total = list(per_language), sum(per_language.values())
    number = {name: i for i, name in enumerate(languages)}
    part = 1_000_000
    chosen = known.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(part)) < int(np.ceil(min(1, sample / total) * part)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), FEATURES + SCRIPTS), np.int64)
        for batch in batches:
            texts, labels = lower_texts(batch.column(0)), batch.column(1).to_pylist()
            for rows in groups_of(texts):
                blob, at = join_texts([texts[i] for i in rows])
                features = _features(blob)
                label = np.array([number[labels[i]] for i in rows])
                letters = ~NOT_LETTER[blob]
                own = np.repeat(label, np.diff(at))
                pairs = own[letters] * (FEATURES + SCRIPTS) + features[letters]
                sums += np.bincount(pairs, minlength=sums.size).reshape(sums.shape)
                start, _, script, _ = _words(blob)
                pairs = own[start] * (FEATURES + SCRIPTS) + FEATURES + script
                sums += np.bincount(pairs, minlength=sums.size).reshape(sums.shape)
        where = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(where), pa.array(sums.ravel()[where])], ["place", "n"])

    counted = map_arrow(bounded_batches(chosen).select("text", "lang"), count, "place bigint, n bigint")
    table = counted.groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # at most languages times features
    sums = np.zeros((len(languages), FEATURES + SCRIPTS))
    sums.ravel()[table["place"].to_numpy()] = table["n"].to_numpy()
    trigrams, scripts = sums[:, :FEATURES].T, sums[:, FEATURES:].T
    used = max(1, int((trigrams.sum(1) > 0).sum()))
    log_p = np.log((trigrams + 0.1) / (trigrams.sum(0) + 0.1 * (used + 1)))
    own = scripts >= OWN_SHARE * np.maximum(1, scripts.sum(0))
    return Model(languages, log_p.astype(np.float32), own)


def viterbi(emission: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best label of each word. `emission` has the words of all sequences one after the other."""
    first = np.cumsum(counts) - counts
    order, live = lockstep(counts)
    first = first[order]
    came = np.empty(emission.shape, np.uint8 if emission.shape[1] < 256 else np.int32)
    stay = np.arange(emission.shape[1])[None, :]
    value = np.zeros((len(counts), emission.shape[1]))
    for t, n in enumerate(live):
        v = value[:n]
        top = v.argmax(1)
        other = v[np.arange(n), top][:, None] - penalty
        came[first[:n] + t] = np.where(v >= other, stay, top[:, None])
        value[:n] = np.maximum(v, other) + emission[first[:n] + t]
    label = np.empty(len(emission), came.dtype)
    now = value.argmax(1)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        place = first[:n] + t
        label[place] = now[:n]
        now[:n] = came[place, now[:n]]
    return label


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def label_texts(texts: list[bytes], model: Model) -> list[tuple[str, float, list[dict]]]:
    """Language, score and spans (language, first and last word plus one) of each lower-cased text."""
    blob, at = join_texts(texts)
    start, stop, script, edges = _words(blob)
    if not len(start):
        return [(UNKNOWN, 0.0, [])] * len(texts)
    features = _features(blob)
    allowed = model.own_script[script]
    emission = np.where(allowed | ~allowed.any(1, keepdims=True), 0.0, -FOREIGN)
    cut = edges[:-1] if edges[-1] >= len(blob) else edges
    for k in range(len(model.languages)):
        emission[:, k] += np.add.reduceat(model.log_p[features, k], cut, dtype=np.float64)[::2]
    counts = np.diff(np.searchsorted(start, at))
    label = viterbi(emission, counts)
    weight = np.zeros((len(texts), len(model.languages)))
    doc = np.repeat(np.arange(len(texts)), counts)
    np.add.at(weight, (doc, label), stop - start)
    best, whole = weight.argmax(1), weight.sum(1)
    turn = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])])
    spans: list[list[dict]] = [[] for _ in texts]
    begin = np.cumsum(counts) - counts
    for low, high in zip(turn, np.r_[turn[1:], len(doc)]):
        d = doc[low]
        spans[d].append({"lang": model.languages[label[low]], "start": int(low - begin[d]), "stop": int(high - begin[d])})
    ascii_letter = ~NOT_LETTER & (np.arange(256) < 128)
    plain = np.add.reduceat(ascii_letter[blob].astype(np.int64), at[:-1])
    return [
        (model.languages[best[i]], float(weight[i, best[i]] / whole[i]), spans[i])
        if whole[i] and (plain[i] or _has_letter(texts[i]))
        else (UNKNOWN, 0.0, [])
        for i in range(len(texts))
    ]


def identify(docs: DataFrame, trained: Column, keep: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE) -> DataFrame:
    """`keep` columns, `lang_pred, score, spans` of each row; learned from rows with `trained` and a `lang`."""
    model = fit(docs, trained, sample)
    rows = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            texts, found = lower_texts(batch.column(len(keep))), []
            for group in groups_of(texts):
                some = [texts[i] for i in group]
                found += label_texts(some, model) if model else [(UNKNOWN, 0.0, [])] * len(some)
            names, scores, marked = zip(*found) if found else ((), (), ())
            own = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(marked, spans)]
            yield pa.record_batch([*batch.columns[: len(keep)], *own], [*keep, "lang_pred", "score", "spans"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(bounded_batches(rows), run, f"{kinds}, lang_pred string, score double, spans array<struct<lang: string, start: int, stop: int>>")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by

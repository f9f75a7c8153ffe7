"""Scores of texts by a Katz backoff model of word pairs, learned from part of the documents.

Counts of one to K times are discounted as Good and Turing have it; what that frees goes to words that were
not seen after the word before, in proportion to their own probability, and among single words to the
unknown word. The backoff weight of each word is computed so that its probabilities add up to one exactly:
log p(w | h) is that of the discounted pair where the pair is in the table, else weight(h) times p(w), and
p(w) in turn that of the discounted word or the unknown one.

All pairs are kept, whatever their counts. Words that make up at least `SHARE` of the training tokens (at
most 1 / SHARE, and the end) are frequent: every task knows them, and they have short numbers. Rare ones
are known only in their partitions. Three passes over the texts:

1. Words are counted, chunk by chunk, and the counts added up in partitions by hash (a stored table).
2. Pairs are counted in the same way (a stored table): pairs of two frequent words by the pair, those with a
   rare second word where that word's count is, other ones where their first word's count is. Pairs of two
   rare words then move to their first word, with the second one's count (a stored table). Per frequent
   first word sums go to the driver; the backoff weights of rare ones are found in their partitions.
3. Texts are scored. Frequent words and the few most frequent pairs are scored on the spot. For the others
   each chunk sends to the partition that has their counts which texts hold them, and sums by text come
   back. What is sent of one word or pair is bounded by the shares below, so no partition is hot.

Defined results: a null text is empty and scores its end alone; texts with one id and text score alike;
without training rows every word is unknown and has probability one; an empty table gives an empty result.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import SPACE, bounded_batches, groups_of, join_texts, map_arrow, mix64, texts_of, word_hashes, words_in
from wardwatch.llm.windows import written
from wardwatch.session import ship

ship(__name__)

#: Least share of the training tokens of a word that every task knows, and of a pair that is scored on the spot.
SHARE, HOT_SHARE = 2e-6, 2e-5
#: Counts up to this are discounted.
K = 5
#: A row is numbered by its task, shifted by so many bits, and its place in the task.
TASK_BITS = 40
#: The smoothed numbers of things seen r times fall at least like this power of r, so every estimate is below its count.
LEAST_SLOPE = -1.1
CHUNK_BYTES = 8 << 20
#: Stands for the end of a text; words' hashes are never so small, nor as small as numbers of frequent words.
END = np.uint64(1)
LEAST_HASH = np.uint64(1 << 24)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased texts and their ends, and where each text begins (one more entry)."""
    blob, at = join_texts(texts)
    start, stop = words_in(blob, SPACE)
    first = np.searchsorted(start, at) + np.arange(len(at))
    out = np.full(first[-1], END)
    owner = np.searchsorted(at, start, "right") - 1
    out[np.arange(len(start)) + owner] = np.maximum(word_hashes(blob, start, stop)[0], LEAST_HASH)
    return out, first


def _chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[list[bytes], pa.Table]]:
    """Lower-cased texts of about CHUNK_BYTES, and the other columns."""
    held: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        own = [t.lower() for t in texts_of(batch.column(text))]
        for rows in groups_of(own, CHUNK_BYTES):
            some = own[rows.start : rows.stop]
            held.append(batch.slice(rows.start, len(some)))
            texts += some
            size += sum(map(len, some))
            if size >= CHUNK_BYTES:
                yield texts, pa.Table.from_batches([b.drop_columns([b.schema.names[text]]) for b in held])
                held, texts, size = [], [], 0
    if held:
        yield texts, pa.Table.from_batches([b.drop_columns([b.schema.names[text]]) for b in held])


def _all_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts, sizes = [np.empty(0, np.uint64)], []
    for rows in groups_of(texts):
        tokens, first = _tokens([texts[i] for i in rows])
        parts.append(tokens)
        sizes.append(np.diff(first))
    counts = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    return np.concatenate(parts), np.r_[0, np.cumsum(counts)].astype(np.int64)


def _squeeze(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True)


def _expand(data: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _count_rows(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket: its keys in order (as differences) and their counts."""
    bucket = _bucket(keys, buckets)
    order = np.lexsort((keys, bucket))
    keys, counts, edges = keys[order], counts[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = [(b, hi - lo, _squeeze(np.diff(keys[lo:hi], prepend=keys.dtype.type(0))), _squeeze(counts[lo:hi])) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["bucket", "n", "keys", "counts"])


def _read_counts(n: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_expand(keys, n, np.uint64), dtype=np.uint64), _expand(counts, n, np.int64)


COUNTS = "bucket int, n int, keys binary, counts binary"
#: Kinds of rows: sums of texts, words, pairs of frequent words, pairs kept with their rare second or rare
#: first word, pairs moved to their first word, sums of frequent first words; and occurrences of rare pairs.
DIRECT, WORD, PAIR, BY_SECOND, BY_FIRST, MOVED, SUMS, RARE = range(8)
PAIR_COUNTS = "bucket int, kind int, n int, keys binary, others binary, counts binary, seconds binary"
_PAIR_TYPES = (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
_PAIR_NAMES = ["bucket", "kind", "n", "keys", "others", "counts", "seconds"]


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_PAIR_NAMES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _PAIR_TYPES)], _PAIR_NAMES)


def _pair_rows(kind: int, keys: np.ndarray, others: np.ndarray, counts: np.ndarray, buckets: int, seconds: np.ndarray | None = None) -> list[tuple]:
    """A row for each bucket of what is in order of keys."""
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [_pair_row(b, kind, *(x[order[lo:hi]] for x in (keys, others, counts)), None if seconds is None else seconds[order[lo:hi]]) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]


def _pair_row(bucket: int, kind: int, keys: np.ndarray, others: np.ndarray, counts: np.ndarray, seconds: np.ndarray | None = None) -> tuple:
    packed = None if kind == PAIR else _squeeze(others)
    return bucket, kind, len(keys), _squeeze(np.diff(keys, prepend=np.uint64(0))), packed, _squeeze(counts), None if seconds is None else _squeeze(seconds)


def _read_pairs(n: int, keys: bytes, others: bytes | None, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, counts = _read_counts(n, keys, counts)
    return keys, np.zeros(n, np.uint64) if others is None else _expand(others, n, np.uint64), counts


def _summed(kind: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal keys and others, added up, in order."""
    keys, others, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(keys) if kind == PAIR else np.lexsort((others, keys))
    keys, others, counts = keys[order], others[order], counts[order]
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (others[1:] != others[:-1])][: len(keys)])
    return keys[first], others[first], np.add.reduceat(counts, first) if len(first) else counts


def _add_up_pairs(sent: DataFrame, buckets: int) -> DataFrame:
    """The pair rows of all chunks, added up: a row for each bucket and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for bucket, kind, n, keys, others, counts, _ in zip(*(c.to_pylist() for c in batch.columns)):
                own = held.setdefault((bucket, kind), [])
                own.append(_read_pairs(n, keys, others, counts))
                if sum(len(p[0]) for p in own) > 2 * len(own[0][0]) + 1_000_000:
                    held[bucket, kind] = [_summed(kind, own)]
        for (bucket, kind), own in held.items():
            yield _pair_batch([_pair_row(bucket, kind, *_summed(kind, own))])

    return map_arrow(sent.repartition(buckets, "bucket"), run, PAIR_COUNTS)


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(mix64(first) * np.uint64(0x9E3779B97F4A7C15) + second)


def _found(keys: np.ndarray, held: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each key, 0 where it is not held; `held` is in order."""
    if not len(held):
        return np.zeros(len(keys), values.dtype)
    place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    return np.where(held[place] == keys, values[place], values.dtype.type(0))


def _add_up(sent: DataFrame, buckets: int) -> DataFrame:
    """The count rows of all chunks, added up: a row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, n, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                own = held.setdefault(bucket, [])
                own.append(_read_counts(n, keys, counts))
                if sum(len(k) for k, _ in own) > 2 * len(own[0][0]) + 1_000_000:
                    held[bucket] = [_merged(own)]
        for own in held.values():
            yield _count_rows(*_merged(own), buckets)

    return map_arrow(sent.repartition(buckets, "bucket"), run, COUNTS)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def discounts(of: np.ndarray) -> np.ndarray:
    """Factors for counts 0 to K, from the numbers of things seen r times (`of[r]`, up to K + 1), after Good and Turing.

    The numbers are spread over the gaps between them and smoothed by a line in logarithms, not less steep than
    `LEAST_SLOPE`. Turing's own estimate holds while it differs significantly from the line's, and lies between 0 and the
    count; from the first that does not differ on, and wherever it lies outside, the line's does. So each factor is
    between 0 and 1, and one odd number changes only its neighbours.
    """
    seen = np.flatnonzero(of[1 : K + 2] > 0) + 1
    slope, start = LEAST_SLOPE, 0.0
    if len(seen) > 1:
        before = np.r_[0, seen[:-1]]
        after = np.r_[seen[1:], 2 * seen[-1] - before[-1]]
        slope, start = np.polyfit(np.log(seen), np.log(of[seen] * 2 / (after - before)), 1)
    smooth = np.exp(start + min(slope, LEAST_SLOPE) * np.log(np.arange(1, K + 2)))
    out, differs = np.zeros(K + 1), True
    for r in range(1, K + 1):
        estimate = line = (r + 1) * smooth[r] / smooth[r - 1]
        if differs and of[r] > 0 and of[r + 1] > 0:
            turing = (r + 1) * of[r + 1] / of[r]
            differs = abs(turing - line) > 1.65 * (r + 1) * np.sqrt(of[r + 1] / of[r] ** 2 * (1 + of[r + 1] / of[r]))
            if differs and 0 < turing < r:
                estimate = turing
        # Katz: counts above K are not discounted, so those below give up that much more.
        most = (K + 1) * smooth[K] / smooth[0]
        factor = (estimate / r - most) / (1 - most)
        out[r] = factor if 0 < factor < 1 else estimate / r
    return out


@dataclass
class Words:
    """What every task knows: totals, and the frequent words with the logs of their probabilities."""

    total: int  # training tokens
    distinct: int
    discount: np.ndarray
    log_unknown: float
    keys: np.ndarray
    counts: np.ndarray

    def log_p(self, counts: np.ndarray) -> np.ndarray:
        kept = counts * np.where(counts <= K, self.discount[np.minimum(counts, K)], 1.0)
        with np.errstate(divide="ignore"):
            return np.where(counts > 0, np.log10(kept / max(1, self.total)), self.log_unknown)

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def number(self, tokens: np.ndarray) -> np.ndarray:
        """Place among the frequent words, or -1."""
        if not len(self.keys):
            return np.full(len(tokens), -1)
        place = np.minimum(np.searchsorted(self.keys, tokens), len(self.keys) - 1)
        return np.where(self.keys[place] == tokens, place, -1)


def count_words(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, _ in _chunks(batches, 0):
            keys, counts = np.unique(_all_tokens(texts)[0], return_counts=True)
            yield _count_rows(keys, counts.astype(np.int64), buckets)

    return written(_add_up(map_arrow(docs.select("text"), run, COUNTS), buckets), "model-words")


def _summaries(table: DataFrame, run, schema: str) -> pa.Table:
    """What `run` makes of the keys and counts of each stored row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                yield run(*_read_counts(n, keys, counts))

    return map_arrow(table.select("n", "keys", "counts"), each, schema)


def word_model(table: DataFrame) -> Words:
    def sums(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        of = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)
        return pa.record_batch([pa.array([int(counts.sum())]), pa.array([len(keys)]), *[pa.array([int(x)]) for x in of[1 : K + 2]]], ["total", "distinct", *[f"n{r}" for r in range(1, K + 2)]])

    names = ["total", "distinct", *[f"n{r}" for r in range(1, K + 2)]]
    got = _summaries(table, sums, ", ".join(f"{c} bigint" for c in names)).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    of = np.r_[0, [got[f"n{r}"] for r in range(1, K + 2)]].astype(float)
    factor = discounts(of)
    freed = float((of[1 : K + 1] * np.arange(1, K + 1) * (1 - factor[1:])).sum())
    if got.total and freed <= 0:  # no rare words at all: half a count of each
        factor, freed = factor, 0.5
    least = max(1, int(np.ceil(SHARE * got.total)))

    def frequent(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        keep = (counts >= least) | (keys == END)
        return pa.record_batch([pa.array(keys[keep].view(np.int64)), pa.array(counts[keep])], ["key", "n"])

    top = _summaries(table, frequent, "key bigint, n bigint").toArrow()  # at most 1 / SHARE rows and the end's
    keys, counts = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(keys)
    unknown = np.log10(freed / got.total) if got.total else 0.0
    return Words(got.total, got.distinct, factor, float(unknown), keys[order], counts[order])


def count_pairs(docs: DataFrame, words: Words, buckets: int) -> DataFrame:
    """All pairs. Those of frequent words as first * (n + 1) + second; first is n at the begin of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, _ in _chunks(batches, 0):
            tokens, at = _all_tokens(texts)
            first, second, rare_first, rare_second = _pair_parts(tokens, words, at)
            both = ~(rare_first | rare_second)
            keys, counts = np.unique(first[both] * np.uint64(len(words.keys) + 1) + second[both], return_counts=True)
            rows = _pair_rows(PAIR, keys, keys, counts.astype(np.int64), buckets)
            for kind, some, owner, other in ((BY_SECOND, rare_second, second, first), (BY_FIRST, rare_first & ~rare_second, first, second)):
                rows += _pair_rows(kind, *_summed(kind, [(owner[some], other[some], np.ones(some.sum(), np.int64))]), buckets)
            yield _pair_batch(rows)

    return written(_add_up_pairs(map_arrow(docs.select("text"), run, PAIR_COUNTS), buckets), "model-pairs")


def _pair_parts(tokens: np.ndarray, words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and second of each pair, as numbers of frequent words and hashes of rare ones, and which are rare."""
    number = words.number(tokens)
    rare_second = number < 0
    second = np.where(rare_second, tokens, number.astype(np.uint64))
    first, rare_first = np.empty_like(second), np.empty_like(rare_second)
    first[1:], rare_first[1:] = second[:-1], rare_second[:-1]
    first[at[:-1]], rare_first[at[:-1]] = len(words.keys), False
    return first, second, rare_first, rare_second


_SUMS = ["first", *[f"n{r}" for r in range(1, K + 3)], "seen", "p"]


def _first_sums(first: np.ndarray, counts: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words, and of each how many pairs occur 1 to K + 1 times, the tokens of the more frequent, all, and the seconds' p."""
    met, place = np.unique(first, return_inverse=True)
    columns = [np.bincount(place, counts == r, len(met)) for r in range(1, K + 2)]
    columns += [np.bincount(place, np.where(counts > K, counts, 0), len(met)), np.bincount(place, counts, len(met)), np.bincount(place, p, len(met))]
    return met.astype(np.int64), np.stack(columns)


def move_pairs(counted: DataFrame, table: DataFrame, words: Words, buckets: int) -> DataFrame:
    """Pairs of two rare words in the partition of their first one, with the count of the second; and sums of the
    pairs with a rare second word by frequent first word (-1 stands for all rare ones)."""

    def run(pairs: pa.Table, known: pa.Table) -> pa.Table:
        held = _merged([(np.empty(0, np.uint64), np.empty(0, np.int64)), *(_read_counts(*r) for r in zip(*(known[c].to_pylist() for c in ("n", "keys", "counts"))))])
        rows = []
        for bucket, n, keys, others, counts in zip(*(pairs[c].to_pylist() for c in ("bucket", "n", "keys", "others", "counts"))):
            second, first, counts = _read_pairs(n, keys, others, counts)
            seconds = _found(second, *held)
            rare = first >= LEAST_HASH
            met, sums = _first_sums(np.where(rare, -1, first.astype(np.int64)), counts, np.where(rare, 0.0, 10 ** words.log_p(seconds)))
            rows.append((bucket, SUMS, len(met), _squeeze(met), _squeeze(sums), None, None))
            order = np.flatnonzero(rare)
            order = order[np.argsort(first[order], kind="stable")]
            rows += _pair_rows(MOVED, first[order], second[order], counts[order], buckets, seconds[order])
        return pa.Table.from_batches([_pair_batch(rows)])

    pairs = counted.where(F.col("kind") == BY_SECOND)
    moved = pairs.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(run, PAIR_COUNTS)
    return written(moved, "model-moved")


@dataclass
class Pairs:
    discount: np.ndarray
    log_weight: np.ndarray  # of each frequent word, and of the begin, as the first of a pair
    first_counts: np.ndarray
    scale: np.ndarray  # under one for words after which nothing would be freed
    hot: np.ndarray
    hot_gain: np.ndarray

    def gain(self, keys: np.ndarray, counts: np.ndarray, words: Words) -> np.ndarray:
        """What a pair in the table adds to the score of backing off."""
        first, second = (keys // np.uint64(len(words.keys) + 1)).astype(np.int64), (keys % np.uint64(len(words.keys) + 1)).astype(np.int64)
        return self.gain_of(first, counts, words.log_p(words.counts)[second])

    def kept(self, counts: np.ndarray) -> np.ndarray:
        return counts * np.where(counts <= K, self.discount[np.minimum(counts, K)], 1.0)

    def gain_of(self, first: np.ndarray, counts: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """The same for frequent first words by their number."""
        return np.log10(self.kept(counts) * self.scale[first] / self.first_counts[first]) - self.log_weight[first] - log_p

    def rare_firsts(self, first: np.ndarray, counts: np.ndarray, log_p: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all pairs of some rare first words, whose counts are `of`: those words, their log weights, and the pairs' gains."""
        met, begin, place = np.unique(first, return_index=True, return_inverse=True)
        own, kept = of[begin].astype(float), self.kept(counts)
        total = np.bincount(place, kept, len(met))
        scale = np.where(total >= own - 1e-9, 1 - 0.5 / np.maximum(own, 1), 1.0)
        log_weight = np.log10((1 - total * scale / own) / np.maximum(1e-300, 1 - np.bincount(place, 10**log_p, len(met))))
        return met, log_weight, np.log10(kept * (scale / own)[place]) - log_weight[place] - log_p


def pair_model(counted: DataFrame, moved: DataFrame, words: Words, texts: int) -> Pairs:
    n, p = len(words.keys), 10 ** words.log_p(words.counts)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, m, keys, others, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == SUMS:
                    met, sums = _expand(keys, m, np.int64), _expand(others, (K + 3) * m + m, np.float64).reshape(-1, m)
                else:
                    keys, counts = _read_counts(m, keys, counts)
                    if kind == PAIR:
                        met, sums = _first_sums((keys // np.uint64(n + 1)).astype(np.int64), counts, p[(keys % np.uint64(n + 1)).astype(np.int64)])
                    else:
                        met, sums = _first_sums(np.full(m, -1), counts, np.zeros(m))
                yield pa.record_batch([pa.array(met), *map(pa.array, sums)], _SUMS)

    columns = ["kind", "n", "keys", "others", "counts"]
    rows = counted.where(F.col("kind") != BY_SECOND).select(columns).unionByName(moved.where(F.col("kind") == SUMS).select(columns))
    sums = map_arrow(rows, each, "first bigint, " + ", ".join(f"{c} double" for c in _SUMS[1:]))
    got = sums.groupBy("first").agg(*[F.sum(c).alias(c) for c in _SUMS[1:]]).toArrow()  # at most 1 / SHARE + 3 rows
    first = got["first"].to_numpy()
    types = np.stack([got[f"n{r}"].to_numpy() for r in range(1, K + 2)]) if len(first) else np.zeros((K + 1, 0))
    factor = discounts(np.r_[0, types.sum(1)])
    frequent_first = first >= 0
    got, first, types = got.filter(pa.array(frequent_first)), first[frequent_first], types[:, frequent_first]
    counts = np.r_[words.counts, texts].astype(float)
    weight, scale = np.ones(n + 1), np.ones(n + 1)
    kept = (types[:K] * (np.arange(1, K + 1) * factor[1:])[:, None]).sum(0) + got[f"n{K + 2}"].to_numpy()
    whole = kept >= counts[first] - 1e-9
    scale[first[whole]] = 1 - 0.5 / counts[first[whole]]
    share = kept * scale[first] / counts[first]
    weight[first] = (1 - share) / np.maximum(1e-300, 1 - got["p"].to_numpy())
    model = Pairs(factor, np.log10(weight), np.maximum(1, counts), scale, np.empty(0, np.uint64), np.empty(0))
    least = max(1, int(np.ceil(HOT_SHARE * words.total)))

    def frequent(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        keep = counts >= least
        return pa.record_batch([pa.array(keys[keep].view(np.int64)), pa.array(counts[keep])], ["key", "n"])

    top = _summaries(counted.where(F.col("kind") == PAIR), frequent, "key bigint, n bigint").toArrow()  # at most 1 / HOT_SHARE rows
    keys = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    model.hot, model.hot_gain = keys[order], model.gain(keys[order], top["n"].to_numpy()[order], words)
    return model


_SENT = pa.schema([
    ("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary()), ("rows", pa.binary()), ("m", pa.int32()), ("base", pa.int64()),
])
_PART = "grp int, kind int, n int, ids binary, a binary, b binary, c binary"


def _occurrences(kind: int, keys: np.ndarray, text: np.ndarray, base: int, buckets: int, owner: np.ndarray | None = None) -> list[tuple]:
    """A row for each bucket (of the keys or their owners): keys in order, in how many texts each occurs (with repeats), and in which.

    Texts are told by their number in the task, counted from `base`; in order and as differences they take about a byte.
    """
    order = np.lexsort((text, keys))
    owner = (keys if owner is None else owner)[order]
    keys, text = keys[order], text[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    size = np.diff(np.r_[first, len(keys)])
    unique = keys[first]
    bucket = _bucket(owner[first], buckets)
    order = np.lexsort((unique, bucket))
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    begin = np.cumsum(size) - size
    out = []
    for b, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if hi == lo:
            continue
        own = order[lo:hi]
        n = size[own]
        place = np.repeat(begin[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        used, which = np.unique(text[place], return_inverse=True)
        out.append((b, kind, hi - lo, _squeeze(np.diff(unique[own], prepend=np.uint64(0))), _squeeze(n.astype(np.uint32)), _squeeze(which.astype(np.uint32)), _squeeze(np.diff(used, prepend=0).astype(np.uint32)), len(used), base))
    return out


def _score_texts(docs: DataFrame, words: Words, pairs: Pairs, buckets: int) -> DataFrame:
    """Rows of `_SENT`: scores of what is frequent, per text, and occurrences of the rest."""
    log_p, log_base, n = words.log_p(words.counts), words.log_base(words.counts), len(words.keys)
    log_p, log_base, log_weight = np.r_[log_p, 0.0], np.r_[log_base, 0.0], np.r_[pairs.log_weight, 0.0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = TaskContext.get().partitionId() << TASK_BITS
        for texts, rest in _chunks(batches, 1):
            rids = rest["rid"].to_numpy()
            first_row, start = start, start + len(texts)
            tokens, at = _all_tokens(texts)
            text = np.repeat(np.arange(len(texts)), np.diff(at))
            first, second, rare_first, rare_second = _pair_parts(tokens, words, at)
            known = ~rare_second
            place = np.where(known, second, np.uint64(n)).astype(np.int64)
            base = np.bincount(text, log_base[place], len(texts))
            # The begin has a weight of its own; that of a rare first word is added where its count is.
            score = np.bincount(text, log_p[place] + log_weight[np.where(rare_first, np.uint64(n + 1), first).astype(np.int64)], len(texts))
            seen = np.bincount(text, known, len(texts))
            both = np.flatnonzero(known & ~rare_first)
            keys = first[both] * np.uint64(n + 1) + second[both]
            if len(pairs.hot):
                place = np.minimum(np.searchsorted(pairs.hot, keys), len(pairs.hot) - 1)
                hot = pairs.hot[place] == keys
                score += np.bincount(text[both[hot]], pairs.hot_gain[place[hot]], len(texts))
                both, keys = both[~hot], keys[~hot]
            rare, mixed = np.flatnonzero(rare_second), np.flatnonzero(rare_first | rare_second)
            rows = _occurrences(WORD, tokens[rare], text[rare], first_row, buckets) + _occurrences(PAIR, keys, text[both], first_row, buckets)
            owner = np.where(rare_first, first, second)[mixed]
            rows += _occurrences(RARE, _pair_hash(first[mixed], second[mixed]), text[mixed], first_row, buckets, owner)
            packed = np.stack([np.diff(at).astype(float), seen, base, score])
            spread = _bucket(first_row + np.arange(len(texts)), buckets)
            order = np.argsort(spread, kind="stable")
            edges = np.searchsorted(spread[order], np.arange(buckets + 1))
            for b, (lo, hi) in enumerate(zip(edges, edges[1:])):
                if hi > lo:
                    own = order[lo:hi]
                    rows.append((b, DIRECT, hi - lo, _squeeze(rids[own]), None, _squeeze(own.astype(np.uint32)), _squeeze(packed[:, own]), 4, first_row))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT)

    return map_arrow(docs.select("rid", "text"), run, "bucket int, kind int, n int, keys binary, sizes binary, texts binary, rows binary, m int, base bigint")


def _sums_by_text(sent: DataFrame, tables: DataFrame, words: Words, pairs: Pairs, buckets: int) -> DataFrame:
    """Rows of `_PART`, per group of texts: sums of what the buckets know."""

    def parts(ids: np.ndarray, *values: np.ndarray) -> list[tuple]:
        spread = _bucket(mix64(ids.view(np.uint64)), buckets)
        order = np.argsort(spread, kind="stable")
        edges = np.searchsorted(spread[order], np.arange(buckets + 1))
        return [(b, 1, hi - lo, _squeeze(np.diff(ids[order[lo:hi]], prepend=0)), *[_squeeze(v[order[lo:hi]]) for v in values]) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]

    def run(sent: pa.Table, known: pa.Table) -> pa.Table:
        counted = {kind: [(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))] for kind in (WORD, PAIR, BY_SECOND, BY_FIRST, MOVED)}
        for kind, n, keys, others, counts, seconds in zip(*(known[c].to_pylist() for c in ("kind", "n", "keys", "others", "counts", "seconds"))):
            counted[kind].append((*_read_pairs(n, keys, others, counts), np.zeros(n, np.int64) if seconds is None else _expand(seconds, n, np.int64)))
        (w, _, w_counts, _), (ff, _, ff_counts, _), back, front, moved = ([np.concatenate(c) for c in zip(*own)] for own in counted.values())
        tables = {kind: _merged([own]) for kind, own in ((WORD, (w, w_counts)), (PAIR, (ff, ff_counts)))}
        # Pairs of a frequent first word and a rare second one, whose count is here.
        second, first, counts = (c[back[1] < LEAST_HASH] for c in back[:3])
        gains = [pairs.gain_of(first.astype(np.int64), counts, words.log_p(_found(second, *tables[WORD])))]
        hashes = [_pair_hash(first, second)]
        # All pairs of the rare first words whose counts are here.
        first, second, counts = (np.r_[a, b] for a, b in zip(front[:3], moved[:3]))
        log_p = np.r_[words.log_p(words.counts)[front[1].astype(np.int64)], words.log_p(moved[3])]
        met, weights, gain = pairs.rare_firsts(first, counts, log_p, _found(first, *tables[WORD]))
        hashes, gains = np.concatenate([*hashes, _pair_hash(first, second)]), np.concatenate([*gains, gain])
        order = np.argsort(hashes)
        tables[RARE] = hashes[order], gains[order]
        ids, sums, out = [np.empty(0, np.int64)], [np.empty((3, 0))], []
        for kind, n, keys, sizes, texts, rows, m, base in zip(*(sent[c].to_pylist() for c in ("kind", "n", "keys", "sizes", "texts", "rows", "m", "base"))):
            if kind == DIRECT:
                rids, own = _expand(keys, n, np.int64), base + _expand(texts, n, np.uint32).astype(np.int64)
                values = _expand(rows, 4 * n, np.float64).reshape(4, n)
                spread = _bucket(mix64(own.view(np.uint64)), buckets)
                for b in np.unique(spread):
                    at = spread == b
                    out.append((int(b), DIRECT, int(at.sum()), _squeeze(np.diff(own[at], prepend=0)), _squeeze(values[:, at]), _squeeze(rids[at]), None))
                continue
            keys, sizes = np.cumsum(_expand(keys, n, np.uint64), dtype=np.uint64), _expand(sizes, n, np.uint32).astype(np.int64)
            count = _found(keys, *tables[kind])
            if kind == WORD:
                values = np.stack([(count > 0).astype(float), words.log_base(count), words.log_p(count) + _found(keys, met, weights)])
            elif kind == RARE:
                values = np.stack([np.zeros(n), np.zeros(n), count])
            else:
                gain = np.zeros(n)
                gain[count > 0] = pairs.gain(keys[count > 0], count[count > 0], words)
                values = np.stack([np.zeros(n), np.zeros(n), gain])
            which = _expand(texts, int(sizes.sum()), np.uint32).astype(np.int64)
            ids.append(base + np.cumsum(_expand(rows, m, np.uint32), dtype=np.int64))
            sums.append(np.stack([np.bincount(which, np.repeat(v, sizes), m) for v in values]))
        every, place = np.unique(np.concatenate(ids), return_inverse=True)
        values = np.concatenate(sums, axis=1)
        if len(every):
            added = [np.bincount(place, v, len(every)) for v in values]
            out += parts(every, added[0].astype(np.int32), added[1], added[2])
        columns = list(zip(*out)) if out else [[]] * 7
        kinds = (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["grp", "kind", "n", "ids", "a", "b", "c"])

    return sent.groupBy("bucket").cogroup(tables.groupBy("bucket")).applyInArrow(run, _PART)


def _gathered(parts: DataFrame, buckets: int) -> DataFrame:
    """`rid, n_tokens, n_known, base_score, score`, one row for each row that was scored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rids, own, more_ids, more = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty((4, 0))], [np.empty(0, np.int64)], [np.empty((3, 0))]
        for batch in batches:
            for kind, n, some, a, b, c in zip(*(batch.column(i).to_pylist() for i in range(1, 7))):
                some = np.cumsum(_expand(some, n, np.int64))
                if kind == DIRECT:
                    ids.append(some)
                    rids.append(_expand(b, n, np.int64))
                    own.append(_expand(a, 4 * n, np.float64).reshape(4, n))
                else:
                    more_ids.append(some)
                    more.append(np.stack([_expand(a, n, np.int32).astype(float), _expand(b, n, np.float64), _expand(c, n, np.float64)]))
        every = np.concatenate(ids)
        if not len(every):
            return
        order = np.argsort(every)
        every, rid = every[order], np.concatenate(rids)[order]
        tokens, known, base, score = np.concatenate(own, axis=1)[:, order]
        added = np.searchsorted(every, np.concatenate(more_ids))
        for total, v in zip((known, base, score), np.concatenate(more, axis=1)):
            total += np.bincount(added, v, len(every))
        whole = lambda x: pa.array(np.rint(x).astype(np.int64))
        yield pa.record_batch([pa.array(rid), whole(tokens), whole(known), pa.array(base), pa.array(score)], ["rid", "n_tokens", "n_known", "base_score", "score"])

    return map_arrow(parts.repartition(buckets, "grp"), run, "rid bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def score_documents(docs: DataFrame, trained: Column, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `n_tokens, n_known, train_tokens, base_score, score` of each row; learned from rows with `trained`."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rid = F.xxhash64("doc_id", "text")
    texts = bounded_batches(docs).select("text", rid.alias("rid"))
    learned = docs.where(trained).select("text")
    table = count_words(learned, buckets)
    words = word_model(table)
    counted = count_pairs(learned, words, buckets)
    moved = move_pairs(counted, table, words, buckets)
    pairs = pair_model(counted, moved, words, learned.count())
    sent = _score_texts(texts, words, pairs, buckets)
    known = table.withColumn("kind", F.lit(WORD)).unionByName(counted.unionByName(moved.where(F.col("kind") == MOVED)), allowMissingColumns=True)
    scores = _gathered(_sums_by_text(sent, known, words, pairs, buckets), buckets)
    ids = docs.select(*keep, rid.alias("rid"))
    # Rows of one id and text have one score.
    joined = ids.join(scores.dropDuplicates(["rid"]), "rid")
    return joined.select(*keep, "n_tokens", "n_known", F.lit(words.total).cast("bigint").alias("train_tokens"), "base_score", "score")

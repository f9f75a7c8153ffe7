"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Only whole documents carry labels, so tokens are labelled first, from a bounded sample of labelled
documents. Words, and beginnings of words, that clean documents seldom use are taken one after the other,
each time the one found in most toxic documents that nothing taken yet explains; so the words of one text
with many copies earn nothing once that text is explained. Their occurrences in toxic documents are the
toxic tokens.

The field has two labels; a token's observation is the word or beginning that was taken, or none. It is
fitted by gradient on documents of the sample, chosen by hash whatever their length; of one with more than
`FIELD_WORDS` words it reads runs of `RUN` words, first those that hold what was taken, spread evenly over the
document, then others at random. Forward and backward passes over the words of many
texts at once give each token's probability. A text's score is a logistic function of the summed
-log(1 - p) of its tokens and of its length, fitted on the sample; tokens above one half are its spans.

Defined results: a null or empty text has no token and scores as a text in which nothing is toxic; an
ill-formed byte ends a word; a text of any length is scored whole, in groups of texts of bounded size, and the
sampled texts are held whole by the driver; without
labels of both kinds all texts score 0.5 less a hair; rows of one id are scored each by its own text, an id
with several labels is toxic if one of them says so. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import NOT_ALNUM, bounded_batches, groups_of, join_texts, lockstep, lower_texts, map_arrow, word_hashes, words_in
from wardwatch.session import ship

ship(__name__)

#: Documents of each label that the model is fitted on, chosen by hash of the id (so many are expected).
SAMPLE = 2_000
#: Of these, the field itself is fitted on so many of each label, and on so many words of each, in runs of so many.
FIELD_DOCS, FIELD_WORDS, RUN = 600, 400, 50
#: A word is taken if it explains so many toxic documents, and this share of them; in clean ones it is at most so many times as frequent.
LEAST_DOCS, LEAST_SHARE, CLEAN_SHARE = 3, 0.004, 0.2
#: Bytes of the beginnings of words that are looked at.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Tokens less probable than this count nothing.
PROBABLE = 0.05
ROUNDS, RATE, DECAY = 80, 0.5, 1e-3


@dataclass
class Model:
    taken: np.ndarray  # hashes of words and beginnings, in order
    kinds: np.ndarray  # observation of each
    sizes: tuple[int, ...]  # lengths of beginnings among them
    weights: np.ndarray  # observation by label; 0 is any other word
    moves: np.ndarray  # label by label
    curve: np.ndarray  # of the score


@dataclass
class Tokens:
    hashes: dict[int, np.ndarray]  # of whole words at 0, of beginnings at their length
    start: np.ndarray
    stop: np.ndarray
    counts: np.ndarray


def tokens(texts: list[bytes], sizes: tuple[int, ...] = BEGINNINGS) -> Tokens:
    """The words of lower-cased texts, with their places in each text."""
    blob, at = join_texts(texts)
    start, stop = words_in(blob, NOT_ALNUM)
    counts = np.diff(np.searchsorted(start, at))
    base = np.repeat(at[:-1], counts)
    *begun, whole = word_hashes(blob, start, *[np.minimum(start + k, stop) for k in sizes], stop)
    hashes = {0: whole | np.uint64(1)}
    for k, h in zip(sizes, begun):
        hashes[k] = np.where(stop - start > k, h & ~np.uint64(1), np.uint64(0))
    return Tokens(hashes, start - base, stop - base, counts)


def observations(model: Model, found: Tokens) -> np.ndarray:
    """The whole word counts before its beginnings, a longer one before a shorter."""
    kinds = np.zeros(len(found.start), np.int64)
    if len(model.taken):
        for k in (*sorted(model.sizes), 0):
            h = found.hashes[k]
            place = np.minimum(np.searchsorted(model.taken, h), len(model.taken) - 1)
            kinds = np.where(model.taken[place] == h, model.kinds[place], kinds)
    return kinds


def marginals(weights: np.ndarray, moves: np.ndarray, kinds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of each label for each token, expected moves between labels, and the summed log partition."""
    first = np.cumsum(counts) - counts
    order, live = lockstep(counts)
    first = first[order]
    emit, move = np.exp(weights[kinds]), np.exp(moves)
    ahead, scale, back = np.empty_like(emit), np.empty(len(emit)), np.empty_like(emit)
    state = np.full((len(counts), 2), 0.5)
    for t, n in enumerate(live):
        now = (state[:n] @ move if t else state[:n]) * emit[first[:n] + t]
        scale[first[:n] + t] = total = now.sum(1)
        ahead[first[:n] + t] = state[:n] = now / total[:, None]
    pairs = np.zeros((2, 2))
    later = np.ones((len(counts), 2))
    for t in range(len(live) - 1, -1, -1):
        n, more = live[t], live[t + 1] if t + 1 < len(live) else 0
        place = first[:n] + t
        if more:
            follow = first[:more] + t + 1
            weighed = later[:more] * emit[follow] / scale[follow][:, None]
            pairs += (ahead[place[:more]].T @ weighed) * move
            later[:more] = weighed @ move.T
        back[place] = later[:n]
    p = ahead * back
    return p / p.sum(1, keepdims=True), pairs, float(np.log(scale).sum())


def _taken(units: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The units taken, given the distinct units of each document."""
    owner = np.repeat(np.arange(len(units)), [len(u) for u in units]).astype(np.int32)
    every, place = np.unique(np.concatenate([*units, np.empty(0, np.uint64)]), return_inverse=True)
    place = place.astype(np.int32)
    bad = np.bincount(place[toxic[owner]], minlength=len(every))
    good = np.bincount(place[~toxic[owner]], minlength=len(every))
    n_bad, n_good = toxic.sum(), (~toxic).sum()
    chosen = (bad >= LEAST_DOCS) & (good * n_bad <= CLEAN_SHARE * bad * n_good) & (every > 0)
    keep = chosen[place] & toxic[owner]
    place, owner = place[keep], owner[keep]
    order = np.argsort(place, kind="stable")
    docs_of, edges = owner[order], np.searchsorted(place[order], np.arange(len(every) + 1))
    by_doc = np.argsort(owner, kind="stable")
    units_of, doc_edges = place[by_doc], np.searchsorted(owner[by_doc], np.arange(len(units) + 1))
    left, open_, taken = np.where(chosen, bad, 0), np.ones(len(units), bool), []
    # Of units that explain as many documents, the one that fewer clean ones hold.
    worth = lambda: left - good / (good.max() + 1.0)
    least = max(LEAST_DOCS, LEAST_SHARE * n_bad)
    while len(left):
        best = int(worth().argmax())
        if left[best] < least:
            break
        taken.append(best)
        for d in docs_of[edges[best] : edges[best + 1]]:
            if open_[d]:
                open_[d] = False
                left[units_of[doc_edges[d] : doc_edges[d + 1]]] -= 1
        left[best] = 0
    return every[np.sort(np.array(taken, np.int64))]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from `doc_id, text` and `doc_id, toxic` (boolean); None unless both labels occur."""
    known = labels.join(docs.select("doc_id").distinct(), "doc_id")
    count = dict(known.groupBy("toxic").count().collect())  # two rows
    if not count.get(True) or not count.get(False):
        return None
    part = 1_000_000
    limit = F.lit(0)
    for label in (True, False):
        limit = F.when(F.col("toxic") == label, F.lit(int(np.ceil(min(1, sample / count[label]) * part)))).otherwise(limit)
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(part)) < limit)
    # About twice `sample` ids, whatever the tables hold; so no text is shuffled.
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = chosen.select("toxic", "text").distinct().orderBy("toxic", F.xxhash64("text"), "text").toArrow()
    toxic = rows["toxic"].to_numpy().astype(bool)
    texts = [t for chunk in rows["text"].chunks for t in lower_texts(chunk)]
    if not toxic.any() or toxic.all():
        return None
    units, lengths = [], []
    for group in groups_of(texts):
        found = tokens([texts[i] for i in group])
        lengths.append(found.counts)
        ends = np.cumsum(found.counts)
        for low, high in zip(ends - found.counts, ends):
            units.append(np.unique(np.concatenate([h[low:high] for h in found.hashes.values()])))
    taken, counts = _taken(units, toxic), np.concatenate(lengths)
    del units
    sizes = BEGINNINGS if len(taken) else ()
    model = Model(taken, 1 + np.arange(len(taken)), sizes, np.zeros((1 + len(taken), 2)), np.zeros((2, 2)), np.zeros(3))
    if len(taken):
        used = set()
        for group in groups_of(texts):
            for k, h in tokens([texts[i] for i in group]).hashes.items():
                if np.isin(taken, h).any():
                    used.add(k)
        model.sizes = tuple(sorted(used - {0}))

    some = counts > 0
    picked = np.concatenate([np.flatnonzero(some & (toxic == label))[:FIELD_DOCS] for label in (True, False)])
    if len(picked):
        kinds, lengths, truths = [], [], []
        rng = np.random.default_rng(len(texts))
        for group in groups_of([texts[i] for i in picked]):
            found = tokens([texts[picked[i]] for i in group], model.sizes)
            ends = np.cumsum(found.counts)
            observed = observations(model, found)
            for i, low, high in zip(group, ends - found.counts, ends):
                for start, stop in field_runs(observed[low:high] > 0, rng):
                    kinds.append(observed[low + start : low + stop])
                    lengths.append(stop - start)
                    truths.append((kinds[-1] > 0) & toxic[picked[i]])
        observed = np.concatenate(kinds)
        _fit_field(model, observed, np.array(lengths), np.concatenate(truths).astype(np.int64))
        # What the fitted documents did not hold is as toxic as the rest of what was taken, on average.
        met = np.isin(1 + np.arange(len(taken)), observed)
        if met.any():
            model.weights[1:][~met] = model.weights[1:][met].mean(0)
    strength = [strengths(model, tokens([texts[i] for i in group], model.sizes))[0] for group in groups_of(texts)]
    weight = np.where(toxic, count[True] / toxic.sum(), count[False] / (~toxic).sum())
    model.curve = _logistic(_design(np.concatenate(strength), counts), toxic, weight / weight.sum())
    return model


def field_runs(held: np.ndarray, rng: np.random.Generator) -> list[tuple[int, int]]:
    """The words of a document that the field is fitted on: all, or runs, given where units taken are held."""
    if len(held) <= FIELD_WORDS:
        return [(0, len(held))]
    starts = np.arange(0, len(held), RUN)
    holds = np.logical_or.reduceat(held, starts)
    most = FIELD_WORDS // RUN
    first, others = np.flatnonzero(holds), np.flatnonzero(~holds)
    # A quarter of the runs is kept for words around which nothing was taken.
    spread = first[np.unique(np.linspace(0, len(first) - 1, min(len(first), most - most // 4)).astype(np.int64))] if len(first) else first
    filled = rng.choice(others, min(len(others), most - len(spread)), replace=False)
    return [(int(starts[i]), int(min(starts[i] + RUN, len(held)))) for i in np.sort(np.concatenate([spread, filled]))]


def _fit_field(model: Model, kinds: np.ndarray, counts: np.ndarray, truth: np.ndarray) -> None:
    """Gradient steps with a rate of its own for each weight, and a small pull towards zero."""
    wanted = np.zeros_like(model.weights)
    np.add.at(wanted, (kinds, truth), 1)
    begins = np.cumsum(counts) - counts
    inner = np.ones(len(kinds), bool)
    inner[begins] = False
    after = np.flatnonzero(inner)
    moved = np.zeros((2, 2))
    np.add.at(moved, (truth[after - 1], truth[after]), 1)
    sums = [np.full_like(model.weights, 1e-6), np.full_like(model.moves, 1e-6)]
    for _ in range(ROUNDS):
        p, pairs, _ = marginals(model.weights, model.moves, kinds, counts)
        expected = np.stack([np.bincount(kinds, p[:, k], len(model.weights)) for k in (0, 1)], 1)
        for weight, slope, total in zip((model.weights, model.moves), (wanted - expected, moved - pairs), sums):
            slope = slope - DECAY * weight
            total += slope * slope
            weight += RATE * slope / np.sqrt(total)


def strengths(model: Model, found: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The summed -log(1 - p) of each text, and p of every word."""
    p = marginals(model.weights, model.moves, observations(model, found), found.counts)[0][:, 1] if len(found.start) else np.empty(0)
    doc = np.repeat(np.arange(len(found.counts)), found.counts)
    loss = np.where(p >= PROBABLE, -np.log1p(-np.minimum(p, 1 - 1e-6)), 0)
    return np.bincount(doc, loss, len(found.counts)), p


def _design(strength: np.ndarray, counts: np.ndarray) -> np.ndarray:
    some = strength > 0
    return np.c_[np.ones(len(strength)), np.log(0.01 + strength), np.where(some, np.log1p(counts), 0)]


def _logistic(design: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps on a slightly penalised likelihood."""
    y, b = toxic.astype(float), np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ b))
        slope = design.T @ (weight * (y - p)) - 1e-4 * b
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(len(b))
        b = b + np.clip(np.linalg.solve(curve, slope), -1, 1)
    return b


def score_documents(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `score, predicted, spans` (byte places in the lower-cased UTF-8 text, and probability)."""
    rows = docs.select(*keep, F.col("text").alias("_text"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = lower_texts(batch.column(len(keep)))
            scores, marked = [], []
            for group in groups_of(texts):
                own: list[list[dict]] = [[] for _ in group]
                marked += own
                if model is None:
                    scores += [0.499] * len(own)
                    continue
                found = tokens([texts[i] for i in group], model.sizes)
                strength, p = strengths(model, found)
                scores += (1 / (1 + np.exp(-_design(strength, found.counts) @ model.curve))).tolist()
                doc = np.repeat(np.arange(len(own)), found.counts)
                for i in np.flatnonzero(p > 0.5):
                    own[doc[i]].append({"start": int(found.start[i]), "stop": int(found.stop[i]), "probability": float(p[i])})
            columns = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(marked, spans)]
            yield pa.record_batch([*batch.columns[: len(keep)], *columns], [*keep, "score", "predicted", "spans"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(bounded_batches(rows), run, f"{kinds}, score double, predicted int, spans array<struct<start: int, stop: int, probability: double>>")


def toxicity(docs: DataFrame, labels: DataFrame, trained: Column, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Scores of all documents by a model learned from the labels of documents with `trained`."""
    label = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    return score_documents(docs, fit(docs.where(trained), label), keep)

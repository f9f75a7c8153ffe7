"""SimHash near-duplicates: fingerprints linked by a self-join of binary tries, and their components.

Fingerprints at most `budget` bits apart are linked. Cut into `budget + 1` blocks, two such fingerprints
agree in at least one whole block. So each distinct fingerprint is put, once per block, under the trie
whose path from the root begins with that block, and a partition joins its tries with themselves: pairs
of nodes go down together, bit by bit, adding up the bits in which their paths differ, and a pair over the
budget is dropped with all that lies below it. All pairs of one depth are handled as arrays. A block that
very many fingerprints share is dealt out by the bits that follow it.

What is shuffled is distinct fingerprints with their smallest id, never documents, so a group of exact
copies is one row after map-side aggregation. A fingerprint has at most 64 + 2016 others within two bits,
so links grow with the fingerprints; each partition hands on only the links that its own union-find did
not have already. Components come from rounds of large-star and small-star steps, with a checkpoint in
the shared folder after each.

Defined results: a null or empty text has fingerprint zero, which is linked like any other; fewer than
`width` words give one shingle of all words; repeated shingles count as often as they occur; rows with
one id each keep their own fingerprint; a component is named after its smallest id, a null id names none;
an empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import bounded_batches, map_arrow, split_words
from wardwatch.session import ship, stage

ship(__name__)

SEED = 42
#: Stands for a null id where documents are kept: after all others.
LAST_ID = (1 << 63) - 1
WIDTH = 3
BUDGET = 2
#: Fingerprints under one block above which they are dealt out by the bits after it, and how many bits.
HOT_BLOCK, MORE_BITS = 100_000, 8
#: Words of a text that are hashed and counted at a time.
WORDS_AT_ONCE = 50_000


def fingerprint(words: list[bytes], width: int = WIDTH) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no words give zero."""
    if not words:
        return 0
    counts, n = np.zeros(64, np.int64), max(1, len(words) - width + 1)
    for at in range(0, n, WORDS_AT_ONCE):
        some = words[at : min(n, at + WORDS_AT_ONCE) + width - 1]
        shingles = map(b" ".join, zip(*[some[k:] for k in range(width)])) if len(some) >= width else [b" ".join(some)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.dtype(">u8"))
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """`doc_id, fp` of each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter(
                (fingerprint(split_words((t.as_py() or b"").lower()), width) for t in texts), np.uint64, len(texts)
            )
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(bounded_batches(docs).select("doc_id", "text"), run, f"doc_id {ids}, fp bigint")


def _rotated(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def trie_pairs(keys: np.ndarray, shared: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sorted distinct 64-bit `keys` whose first `shared` bits agree and that differ in at most `budget` bits.

    A node is a range of keys. `a` and `b` are the nodes of the pairs, `off` their differing bits so far.
    """
    if len(keys) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    block = keys >> np.uint64(64 - shared)
    start = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    stop = np.r_[start[1:], len(keys)]
    large = stop - start > 1
    a_lo = b_lo = start[large]
    a_hi = b_hi = stop[large]
    off = np.zeros(len(a_lo), np.int8)
    for depth in range(shared, 64):
        bit = np.uint64(63 - depth)
        ones = np.r_[0, np.cumsum((keys >> bit).astype(np.uint8) & 1, dtype=np.int64)]
        a_mid, b_mid = a_hi - (ones[a_hi] - ones[a_lo]), b_hi - (ones[b_hi] - ones[b_lo])
        same, parts = a_lo == b_lo, []
        for (l1, h1), (l2, h2), more in (
            ((a_lo, a_mid), (b_lo, b_mid), 0),
            ((a_mid, a_hi), (b_mid, b_hi), 0),
            ((a_lo, a_mid), (b_mid, b_hi), 1),
            ((a_mid, a_hi), (b_lo, b_mid), 1),
        ):
            keep = (h1 > l1) & (h2 > l2) & (off + more <= budget)
            if not more:
                keep &= ~(same & (h1 - l1 < 2))
            elif l1 is a_mid:
                keep &= ~same
            parts.append((l1[keep], h1[keep], l2[keep], h2[keep], off[keep] + np.int8(more)))
        a_lo, a_hi, b_lo, b_hi, off = (np.concatenate(x) for x in zip(*parts))
    return a_lo, b_lo


def forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the smallest of its component: what a partition knows, without the pairs it took."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        for side in (left, right):
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def trie_links(fps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """`left, right`: links of distinct fingerprints `fp` that have the components of all pairs within `budget` bits."""
    blocks = budget + 1
    ends = [64 * k // blocks for k in range(blocks + 1)]
    narrow = min(b - a for a, b in zip(ends, ends[1:]))
    spun = fps.select("fp", F.explode(F.array(*[F.lit(e) for e in ends[:-1]])).alias("spin"))
    cases = F.col("fp")
    for by in ends[1:-1]:
        cases = F.when(F.col("spin") == by, _rotated(F.col("fp"), by)).otherwise(cases)
    keyed = spun.select("spin", cases.alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        spins, keys = table["spin"].to_numpy(), table["key"].to_numpy().view(np.uint64)
        for spin in np.unique(spins):
            own = np.unique(keys[spins == spin])
            moved, low = forest(len(own), *trie_pairs(own, narrow, budget))
            by = np.uint64(spin)
            back = (own >> by) | (own << np.uint64(64 - spin)) if spin else own
            back = back.view(np.int64)
            yield pa.record_batch([pa.array(back[moved]), pa.array(back[low])], ["left", "right"])

    keyed = keyed.withColumn("block", F.shiftrightunsigned("key", 64 - narrow))
    crowded = keyed.groupBy("spin", "block").count().where(F.col("count") > HOT_BLOCK).select("spin", "block")
    crowded = stage(crowded, "simhash-crowded")
    # Under a crowded block, the next bits of two that are linked differ in no more than the budget: each goes to
    # its own value of these bits and to all values so near.
    near = [m for m in range(1 << MORE_BITS) if m.bit_count() <= budget]
    after = F.shiftrightunsigned("key", 64 - narrow - MORE_BITS).bitwiseAND(F.lit((1 << MORE_BITS) - 1))
    dealt = keyed.join(crowded, ["spin", "block"], "left_semi")
    dealt = dealt.withColumn("more", F.explode(F.transform(F.array(*[F.lit(m) for m in near]), lambda m: after.bitwiseXOR(m.cast("long")))))
    parts = keyed.join(crowded, ["spin", "block"], "left_anti").withColumn("more", F.lit(-1).cast("long")).unionByName(dealt)
    met = parts.repartition("spin", "block", "more").select("spin", "key")
    return map_arrow(met, run, "left bigint, right bigint")


def components(links: DataFrame, least_id: DataFrame) -> DataFrame:
    """`fp, component_id` for the fingerprints of `least_id` (`fp, least`), from their `links` (`left, right`).

    Large-star and small-star in turn: nodes are linked to the smallest neighbour until links no longer change.
    Nodes are compared by fingerprint, so ties cannot arise; the id comes in at the end.
    """
    edges = stage(links.where("left <> right").distinct(), "simhash-links")
    tally = None
    while True:
        both = edges.unionByName(edges.select(F.col("right").alias("left"), F.col("left").alias("right")))
        low = both.groupBy("left").agg(F.least(F.min("right"), F.col("left")).alias("low"))
        large = both.where("right > left").join(low, "left").select(F.col("right").alias("left"), F.col("low").alias("right"))
        down = large.where("left <> right").distinct()
        turned = down.select(F.greatest("left", "right").alias("left"), F.least("left", "right").alias("right"))
        least = turned.groupBy("left").agg(F.min("right").alias("low"))
        small = turned.join(least, "left").select(F.col("right").alias("left"), F.col("low").alias("right"))
        small = small.unionByName(least.select("left", F.col("low").alias("right")))
        edges = stage(small.where("left <> right").distinct(), "simhash-links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("left", "right").cast("decimal(38,0)"))).first()
        if now == tally:
            break
        tally = now
    named = least_id.join(edges.withColumnRenamed("left", "fp"), "fp", "left").withColumn("root", F.coalesce("right", "fp"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "root").select("fp", "component_id")


def simhash_groups(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET) -> DataFrame:
    """`doc_id, fingerprint, component_id` for each row."""
    marked = stage(fingerprints(docs, width), "simhash-fingerprints")
    least_id = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = components(trie_links(least_id, budget), least_id)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(found, "fp").select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET) -> DataFrame:
    """One document of each component: the smallest id (null last), of rows of one id that with the smaller hash of its text."""
    key = F.struct(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("hash"))
    groups = simhash_groups(docs.select(key.alias("doc_id"), "text"), width, budget)
    groups = stage(groups.select("doc_id", "component_id"), "simhash-groups")
    keyed = docs.withColumn("_key", key)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_key")).distinct()
    left = keyed.join(gone, "_key", "left_anti")
    again = groups.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_key"))
    if not again.isEmpty():  # rows with one id and one text
        again = stage(again, "simhash-again")
        left = left.join(again, "_key", "left_anti").unionByName(left.join(again, "_key", "left_semi").dropDuplicates(["_key"]))
    return left.drop("_key")

"""Where windows of a fixed length occur more than once, over all documents.

Both dedup operators ask this, one over words and one over bytes. Four steps keep the data that moves small:

1. Anchors. A window's anchor is the smallest hash among its short grams. Equal windows have equal anchors,
   and neighbouring windows mostly share theirs, so runs of windows with one anchor are the unit of work:
   about one for sixteen symbols. The anchors of all documents are dealt out by hash, as arrays, and those
   met only once end here. An anchor that a chunk of documents holds several times is sent once, whatever
   its number, so common passages do not pile up.
2. Segments. The documents that hold repeated anchors are cut once more, and the text under each run with a
   repeated anchor (its segment) is written to the shared folder.
3. Values. Segments meet by anchor, in blocks of whole anchor groups of a bounded size. An index over the
   block (a suffix tree, or a run-length index) gives each window its value: how often it occurs, or the
   first document that it occurs in. Anchors with very many segments, such as the edges of a passage in a
   third of all documents, are taken at full length instead: their windows are aggregated by content.
4. Spans. Windows whose value meets the rule become spans of symbols, gathered by document.

Exact copies of a text are found first, by two hashes and the length, and only one of them is cut into
segments; what becomes of the others follows from their being copies.

Hashes only decide what meets; anchors that collide cost work, not results. The windows of anchors at full
length are told apart by two hashes, 112 bits together.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.llm.common import (
    _VALUES,
    SPACE,
    bounded_batches,
    groups_of,
    join_texts,
    map_arrow,
    mix64,
    powers,
    prefix_hash,
    span_hash,
    texts_of,
    word_hashes,
    words_in,
)
from wardwatch.session import ship, work_dir

ship(__name__)

#: Bytes of text whose anchors are sent together, bytes of segments in one index, and windows in a segment at most.
CHUNK_BYTES, BLOCK_BYTES, LONGEST_RUN = 8 << 20, 1 << 20, 256
#: Symbols that are hashed at a time.
PIECE = 1 << 20
#: Segments of one anchor above which its windows are taken at full length; about a block of bytes' segments.
HOT = 1 << 14
#: Bits of an anchor that are kept.
ANCHOR_BITS = 48
#: Stands in for a null id: after all others.
LAST_ID = (1 << 63) - 1
#: Ends the span of a text that goes whole.
WHOLE = (1 << 31) - 1


@dataclass(frozen=True)
class Kind:
    """What a symbol is, and what a window's value is."""

    window: int
    gram: int
    by_word: bool
    #: Whether the value is the first document of a window, or else the number of its occurrences.
    first_doc: bool


@dataclass
class Symbols:
    hashes: np.ndarray
    at: np.ndarray  # first symbol of each text, one more entry
    blob: np.ndarray
    start: np.ndarray  # first byte of each symbol
    stop: np.ndarray


def symbols_of(texts: list[bytes], kind: Kind) -> Symbols:
    if not kind.by_word:
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=at[1:])
        blob = np.frombuffer(b"".join(texts), np.uint8)
        place = np.arange(len(blob))
        return Symbols(_VALUES[blob], at, blob, place, place + 1)
    blob, begins = join_texts([b" ".join(t.split()) for t in texts])
    start, stop = words_in(blob, SPACE)
    return Symbols(word_hashes(blob, start, stop)[0], np.searchsorted(start, begins), blob, start, stop)


def runs_of(symbols: np.ndarray, at: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, text, first window (a symbol's place over all texts) and number of windows of each run."""
    n, w = len(symbols) - kind.window + 1, kind.window - kind.gram + 1
    out = []
    for low in range(0, max(n, 0), PIECE):
        high = min(n, low + PIECE)
        piece = symbols[low : high + kind.window - 1]
        sums = prefix_hash(piece)
        grams = mix64((sums[kind.gram :] - sums[: -kind.gram]) * powers(len(sums), inverse=True)[: len(sums) - kind.gram])
        least, size = grams, 1
        while size < w:
            step = min(size, w - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        edge = np.zeros(high - low + 1, np.int32)
        first, last = np.maximum(at[:-1], low), np.minimum(at[1:] - kind.window + 1, high)
        some = last > first
        np.add.at(edge, first[some] - low, 1)
        np.add.at(edge, last[some] - low, -1)
        valid = np.cumsum(edge[:-1]) > 0
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
        new[np.minimum(first[some] - low, len(new) - 1)] = True
        begin = np.flatnonzero(new)
        if not len(begin):
            continue
        size = np.add.reduceat(valid.astype(np.int64), begin)
        parts = -(-size // LONGEST_RUN)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, left = np.repeat(begin, parts) + LONGEST_RUN * inner, np.repeat(size, parts) - LONGEST_RUN * inner
        out.append((least[begin] >> np.uint64(64 - ANCHOR_BITS), begin + low, np.minimum(left, LONGEST_RUN)))
    if not out:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    anchor, begin, size = (np.concatenate(x) for x in zip(*out))
    return anchor, np.searchsorted(at, begin, "right") - 1, begin, size


def _self_repeating(symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, kind: Kind) -> np.ndarray:
    """Runs with a gram that occurs twice in them; only these can hold one window twice."""
    out = np.zeros(len(begin), bool)
    reach = size + kind.window - kind.gram
    if not len(begin):
        return out
    # A window that comes again within a run lies a period apart, so its first and last grams do too.
    sums = prefix_hash(symbols)
    for at in range(0, len(begin), 20_000):
        b, r = begin[at : at + 20_000], reach[at : at + 20_000]
        owner = np.repeat(np.arange(len(b)), r)
        place = b[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(r) - r, r)
        gram = span_hash(sums, place, place + kind.gram)
        order = np.lexsort((gram, owner))
        same = (owner[order][1:] == owner[order][:-1]) & (gram[order][1:] == gram[order][:-1])
        out[at + np.unique(owner[order][1:][same])] = True
    return out


def _six(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _pack(ids: np.ndarray) -> bytes:
    return pa.compress(np.diff(ids, prepend=0).astype("<i8").tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), "<i8"))


def _group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (mix64(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int64)


def _by_document(anchors: np.ndarray, ids: np.ndarray, groups: int) -> list[tuple]:
    """A row for each group of documents: group, ids, how many anchors each has, and these."""
    order = np.lexsort((ids, _group_of(ids, groups)))
    anchors, ids = anchors[order], ids[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]][: len(ids)])
    count, docs = np.diff(np.r_[first, len(ids)]), ids[first]
    edges = np.searchsorted(_group_of(docs, groups), np.arange(groups + 1))
    upto = np.r_[first, len(ids)]
    return [(g, _pack(docs[lo:hi]), _pack(count[lo:hi]), hi - lo, _six(anchors[upto[lo] : upto[hi]])) for g, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]


_SENT = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("n", pa.int32()), ("keys", pa.binary()), ("known", pa.binary())])
_HELD = pa.schema([("grp", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("n", pa.int32()), ("keys", pa.binary())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _send(anchors: np.ndarray, ids: np.ndarray, twice: np.ndarray, buckets: int, kind: Kind) -> pa.RecordBatch:
    """Rows of `_SENT`: per bucket the anchors that one document of the chunk holds, and those known to be repeated;
    without `known`, per group of documents the anchors that the chunk alone shows to be repeated."""
    order = np.lexsort((ids, anchors))
    anchors, ids, twice = anchors[order], ids[order], twice[order]
    if kind.first_doc:
        keep = np.r_[True, (anchors[1:] != anchors[:-1]) | (ids[1:] != ids[:-1])][: len(anchors)]
        anchors, ids, twice = anchors[keep], ids[keep], twice[keep]
    first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]][: len(anchors)])
    count = np.diff(np.r_[first, len(anchors)])
    many = (count > 1) | (np.logical_or.reduceat(twice, first) if len(first) else np.empty(0, bool))
    own = np.repeat(many, count)
    rows: list[tuple] = []
    single, single_ids, known = anchors[~own], ids[~own], anchors[first[many]]
    order = np.lexsort((single_ids, single % np.uint64(buckets)))
    single, single_ids = single[order], single_ids[order]
    known = known[np.argsort(known % np.uint64(buckets), kind="stable")]
    edges = np.searchsorted(single % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
    known_edges = np.searchsorted(known % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
    for b in range(buckets):
        low, high, kl, kh = edges[b], edges[b + 1], known_edges[b], known_edges[b + 1]
        if high > low or kh > kl:
            rows.append((b, _pack(single_ids[low:high]), None, high - low, _six(single[low:high]), _six(known[kl:kh])))
    rows += [(*row, None) for row in _by_document(anchors[own], ids[own], buckets)]
    return _rows(rows, _SENT)


def repeated_anchors(docs: DataFrame, kind: Kind) -> DataFrame:
    """`doc_id, keys`: anchors of each document that occur more than once (in two documents, where documents count)."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            texts, ids = texts_of(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for rows in groups_of(texts):
                s = symbols_of([texts[i] for i in rows], kind)
                anchor, doc, begin, n = runs_of(s.hashes, s.at, kind)
                twice = np.zeros(len(anchor), bool) if kind.first_doc else _self_repeating(s.hashes, begin, n, kind)
                held.append((anchor, ids[rows.start : rows.stop][doc], twice))
                size += len(s.blob)
                if size >= CHUNK_BYTES:
                    yield _send(*(np.concatenate(x) for x in zip(*held)), buckets, kind)
                    held, size = [], 0
        if held:
            yield _send(*(np.concatenate(x) for x in zip(*held)), buckets, kind)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, known = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for batch in batches:
            for grp, docs, counts, n, k, sure in zip(*(c.to_pylist() for c in batch.columns)):
                if sure is None:
                    yield _rows([(grp, docs, counts, n, k)], _HELD)
                else:
                    keys.append(_from_six(k))
                    ids.append(_unpack(docs, n))
                    known.append(_from_six(sure))
        key, doc, sure = np.concatenate(keys), np.concatenate(ids), np.concatenate(known)
        del keys, ids, known
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        if kind.first_doc:
            same[1:-1] &= doc[1:] != doc[:-1]
        more = same[1:] | same[:-1] | np.isin(key, sure)
        # Of an anchor that occurs in several documents, all of them.
        yield _rows(_by_document(key[more], doc[more], buckets), _HELD)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for batch in batches:
            for _, docs, counts, n, k in zip(*(c.to_pylist() for c in batch.columns)):
                keys.append(_from_six(k))
                ids.append(np.repeat(_unpack(docs, n), _unpack(counts, n)))
        key, doc = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(doc, kind="stable")
        key, doc = key[order], doc[order]
        cut = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]][: len(doc)]), len(doc)]
        for at in range(0, len(cut) - 1, 2_000):
            edges = cut[at : at + 2_001]
            yield pa.record_batch([pa.array(doc[edges[:-1]]), pa.array([_six(key[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())], ["doc_id", "keys"])

    sent = map_arrow(docs.select("doc_id", "text"), send, "bucket int, docs binary, counts binary, n int, keys binary, known binary")
    held = map_arrow(sent.repartition(buckets, "bucket"), meet, "grp int, docs binary, counts binary, n int, keys binary")
    return map_arrow(held.repartition(buckets, "grp"), gather, "doc_id bigint, keys binary")


def _slices(blob: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """The bytes from low to high as one binary array."""
    size = high - low
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    data = blob[np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], size)]
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def copies(docs: DataFrame, kind: Kind) -> DataFrame:
    """`doc_id, text_hash, spare, whole`: texts that others equal; spare ones need no segments of their own, whole ones are removed whole."""
    same = [F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), F.octet_length("text").alias("bytes")]
    rows = docs.where("text IS NOT NULL").select("doc_id", "text_hash", *same)
    first = rows.groupBy("h1", "h2", "bytes").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    met = rows.join(first, ["h1", "h2", "bytes"]).select("doc_id", "text_hash", (F.col("doc_id") > F.col("first")).alias("spare"))
    whole = F.col("spare") if kind.first_doc else F.lit(True)
    return met.distinct().withColumn("whole", whole)


def segments(docs: DataFrame, alike: DataFrame, kind: Kind) -> DataFrame:
    """`doc_id, text_hash, start, weight, key, content`: runs of windows with a repeated anchor; start counts symbols of the text."""
    held = repeated_anchors(docs, kind)
    by_doc = alike.groupBy("doc_id").agg(F.collect_list(F.struct("text_hash", "spare")).alias("alike"))
    rows = docs.join(held.join(by_doc, "doc_id", "left"), "doc_id").select("doc_id", "text_hash", "text", "keys", "alike")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, wanted, hashes = texts_of(batch.column(2)), batch.column(3).to_pylist(), batch.column(1).to_pylist()
            marks = [{m["text_hash"]: m["spare"] for m in own or ()} for own in batch.column(4).to_pylist()]
            spare = np.array([m.get(h, False) for m, h in zip(marks, hashes)], bool)
            weight = np.array([1 + (h in m) for m, h in zip(marks, hashes)], np.int32)
            texts = [b"" if gone else t for t, gone in zip(texts, spare)]
            for rows in groups_of(texts):
                s = symbols_of([texts[i] for i in rows], kind)
                anchor, doc, begin, n = runs_of(s.hashes, s.at, kind)
                keys = [_from_six(wanted[i]) for i in rows]
                owner = np.repeat(np.arange(len(keys), dtype=np.uint64), [len(k) for k in keys])
                shift = np.uint64(ANCHOR_BITS)
                keep = np.isin(anchor | (doc.astype(np.uint64) << shift), np.concatenate(keys) | (owner << shift))
                anchor, doc, begin, n = anchor[keep], doc[keep], begin[keep], n[keep]
                if not len(anchor):
                    continue
                content = _slices(s.blob, s.start[begin], s.stop[begin + n + kind.window - 2])
                at = doc + rows.start
                place = pa.array(at)
                yield pa.record_batch(
                    [batch.column(0).take(place), batch.column(1).take(place), pa.array((begin - s.at[doc]).astype(np.int32)), pa.array(weight[at]), pa.array(anchor.view(np.int64)), content],
                    ["doc_id", "text_hash", "start", "weight", "key", "content"],
                )

    return map_arrow(rows, cut, "doc_id bigint, text_hash bigint, start int, weight int, key bigint, content binary")


#: Symbols of distinct texts, number of windows of each and its weight or first document, to a value per window.
Index = Callable[[Symbols, np.ndarray, np.ndarray, Kind], np.ndarray]


def _spans(value: np.ndarray, doc: np.ndarray, first: np.ndarray, n: np.ndarray, start: np.ndarray, kind: Kind):
    """Runs of windows that the rule removes: row, first symbol, and last plus one. Windows of row i are value[first[i] :][: n[i]]."""
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    own = value[first[row] + place]
    gone = own < doc[row] if kind.first_doc else own > 1
    turn = np.diff(np.r_[0, gone.astype(np.int8), 0])
    breaks = np.r_[row[1:] != row[:-1], True][: len(row)]
    ends = gone & (np.r_[turn[1:-1] == -1, True][: len(row)] | breaks)
    begins = gone & ((turn[:-1] == 1)[: len(row)] | np.r_[True, breaks[:-1]][: len(row)])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    return row[a], start[row[a]] + place[a], start[row[a]] + place[b] + kind.window


def _cold_spans(parts: DataFrame, kind: Kind, index: Index) -> DataFrame:
    names = ["doc_id", "text_hash", "start", "stop"]

    def solve(block: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(block).combine_chunks()
        key, doc = rows["key"].to_numpy(), rows["doc_id"].to_numpy()
        content = pa.table([rows["key"], rows["content"]], ["key", "content"])
        distinct = content.append_column("row", pa.array(np.arange(len(key)))).group_by(["key", "content"], use_threads=False).aggregate([("row", "list")])
        lists = distinct["row_list"].combine_chunks()
        group = np.empty(len(key), np.int64)
        group[lists.flatten().to_numpy()] = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        if kind.first_doc:
            weight = np.full(len(lists), LAST_ID)
            np.minimum.at(weight, group, doc)
        else:
            weight = np.bincount(group, rows["weight"].to_numpy(), len(lists)).astype(np.int64)
        s = symbols_of(distinct["content"].to_pylist(), kind)
        each = np.diff(s.at) - kind.window + 1
        value = index(s, each, weight, kind)
        first = (np.cumsum(each) - each)[group]
        row, low, high = _spans(value, doc, first, each[group], rows["start"].to_numpy().astype(np.int64), kind)
        place = pa.array(row)
        ids, texts = (rows[c].combine_chunks().take(place) for c in ("doc_id", "text_hash"))
        return pa.record_batch([ids, texts, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # Blocks end where the key changes.
            key = batch.column(4).to_numpy()
            if block and size >= BLOCK_BYTES:
                upto = int(np.searchsorted(key, block[-1].column(4)[-1].as_py(), "right"))
                if upto:
                    block.append(batch.slice(0, upto))
                if upto < batch.num_rows:
                    yield solve(block)
                    block, size = [], 0
                    batch = batch.slice(upto)
                else:
                    continue
            block.append(batch)
            size += batch.column(5).nbytes
        if block:
            yield solve(block)

    met = parts.select("doc_id", "text_hash", "start", "weight", "key", "content").repartition("key").sortWithinPartitions("key")
    return map_arrow(met, run, "doc_id bigint, text_hash bigint, start int, stop int")


def _hot_spans(parts: DataFrame, kind: Kind) -> DataFrame:
    """By content: windows of distinct segments are aggregated, and their values go back to the segments."""
    parts = parts.withColumn("ch", F.xxhash64("content"))
    weight = F.min("doc_id") if kind.first_doc else F.sum("weight")
    distinct = parts.groupBy("key", "ch").agg(F.first("content").alias("content"), weight.alias("weight"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            for rows in groups_of(texts):
                s = symbols_of([texts[i] for i in rows], kind)
                n = np.maximum(0, np.diff(s.at) - kind.window + 1)
                row = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                sums = prefix_hash(mix64(s.hashes + np.uint64(1)))
                begin = s.at[row] + place
                hashed = span_hash(sums, begin, begin + kind.window)
                own = pa.array(row + rows.start)
                yield pa.record_batch([*(batch.column(c).take(own) for c in (0, 1)), pa.array(place.astype(np.int32)), pa.array(hashed.view(np.int64)), batch.column(3).take(own)], ["key", "ch", "place", "wh", "weight"])

    each = map_arrow(distinct.select("key", "ch", "content", "weight"), windows, "key bigint, ch bigint, place int, wh bigint, weight bigint")
    total = F.min("weight") if kind.first_doc else F.sum("weight")
    values = each.groupBy("key", "wh").agg(total.alias("value"))
    placed = each.select("key", "ch", "place", "wh").join(values, ["key", "wh"])
    # In order of place; a segment has at most LONGEST_RUN windows.
    by_segment = placed.groupBy("key", "ch").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("values"))
    back = parts.select("doc_id", "text_hash", "start", "key", "ch").join(by_segment, ["key", "ch"])
    gone = (lambda v: v < F.col("doc_id")) if kind.first_doc else (lambda v: v > 1)
    hit = F.concat(F.array(F.lit(False)), F.transform("values", gone), F.array(F.lit(False)))
    turns = lambda on: F.filter(
        F.transform(F.sequence(F.lit(1), F.size("hit") - 1), lambda i: F.when((F.get("hit", i) == on) & (F.get("hit", i - 1) != on), F.col("start") + i - 1)),
        lambda x: x.isNotNull(),
    )
    runs = back.select("doc_id", "text_hash", "start", hit.alias("hit")).select("doc_id", "text_hash", F.explode(F.arrays_zip(turns(True).alias("low"), turns(False).alias("high"))).alias("run"))
    return runs.select("doc_id", "text_hash", F.col("run.low").cast("int").alias("start"), (F.col("run.high") - 1 + kind.window).cast("int").alias("stop"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back; what the steps before have shuffled is no longer needed then."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # lets Spark's cleaner remove the shuffle files of finished steps
    return spark.read.schema(schema).parquet(path)


def with_ids(docs: DataFrame, row: bool = False) -> DataFrame:
    """`doc_id` (null last), `text_hash`, `text`, and the other columns and the length as `_row` where they are asked for."""
    ids = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    others = [F.col(c).alias(f"c_{c}") for c in docs.columns if c != "text"]
    whole = [F.struct(*others, F.length("text").alias("length")).alias("_row")] if row else []
    return bounded_batches(docs).select(ids.alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text", *whole)


def removed_spans(docs: DataFrame, kind: Kind, index: Index, name: str) -> DataFrame:
    """`doc_id, text_hash, spans`: for each document the spans of symbols that the rule removes, unordered; from `with_ids`."""
    alike = written(copies(docs, kind), f"{name}-copies")
    found = written(segments(docs, alike, kind), f"{name}-segments")
    hot = found.groupBy("key").count().where(F.col("count") > HOT).select("key")
    hot = written(hot, f"{name}-hot")
    cold = _cold_spans(found.join(hot, "key", "left_anti"), kind, index)
    spans = cold.unionByName(_hot_spans(found.join(hot, "key", "left_semi"), kind))
    all_of = alike.where("whole").select("doc_id", "text_hash", F.lit(0).alias("start"), F.lit(WHOLE).alias("stop"))
    # There are no more spans than windows of a text.
    per_doc = spans.unionByName(all_of).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return written(per_doc, f"{name}-spans")


def covered(spans: list[dict] | None, n: int, kind: Kind) -> np.ndarray:
    """Which of n symbols lie in a span. A text that goes whole must have a window."""
    edge = np.zeros(n + 1, np.int32)
    spans = [s for s in spans or () if s["stop"] < WHOLE or n >= kind.window]
    if spans:
        np.add.at(edge, [s["start"] for s in spans], 1)
        np.add.at(edge, [min(n, s["stop"]) for s in spans], -1)
    return np.cumsum(edge[:-1]) > 0


def matched(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents of `with_ids` with their spans, null where there are none."""
    return docs.join(spans, ["doc_id", "text_hash"], "left").select(*docs.columns, "spans")

"""Benchmark decontamination: which words of a document lie in a window of a benchmark item.

A set join with prefix filter. Windows of benchmark items are sets of positioned shingles. A document
that holds a window holds all of its shingles, so one of them is a necessary prefix; the rarest over
all documents is taken. Document shingles are looked up among these few by hash; where one is found, its
place in the window fixes where the window must begin, the document must be long enough on both sides,
and the words are compared one by one. No document is shuffled: looking up, bounds and comparison are one
generated stage over the scan, and only counts and hits leave it.

The table of prefixes is broadcast in blocks of a checked size. Each block costs a pass over the documents.

Defined results: a null or wordless text has 0 words and no hit; an item without words has no window;
rows of one id and text are alike; rows of one id with other texts are judged each by its own text; items
of one id count once, a null item id is the empty text; an empty benchmark hits nothing. Further columns
are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.session import stage

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BETWEEN = WORD.replace("[^", "[")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
SHINGLE = 3
SHARE = 20
#: Words of windows in one broadcast, some 30 bytes each with their row.
BLOCK_WORDS = 1_000_000


def lowered(text: str) -> Column:
    """Only A-Z change, whatever the locale."""
    return F.translate(F.col(text), UPPER, LOWER)


def words_of(text: str) -> Column:
    """Cutting at what lies between is much cheaper than extracting each word."""
    return F.coalesce(F.array_remove(F.split(lowered(text), BETWEEN), ""), F.array().cast("array<string>"))


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """`item_id, words`: runs of `window` words; an item of fewer is one window."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of("text").alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    at = words.where(F.size("all") > 0).select("item_id", "all", F.explode(starts).alias("at"))
    return at.select("item_id", F.slice("all", F.col("at"), F.lit(window)).alias("words")).distinct()


def _shingles(rows: DataFrame, words: str, width: int, *keep: str) -> DataFrame:
    """`at` (from 0) and hash `h` of each shingle of `width` words, beside the columns to keep."""
    shifted = [F.col(words)] + [F.slice(F.col(words), F.lit(k + 1), F.greatest(F.size(words), F.lit(1))) for k in range(1, width)]
    zipped = F.arrays_zip(*[a.alias(f"w{k}") for k, a in enumerate(shifted)])
    each = rows.select(*keep, F.posexplode(zipped).alias("at", "_s"))
    parts = [F.col("_s").getField(f"w{k}") for k in range(width)]
    return each.where(parts[-1].isNotNull()).select(*keep, "at", F.xxhash64(*parts).alias("h"))


def prefixes(documents: DataFrame, windows: DataFrame, width: int, blocks: int) -> DataFrame:
    """`h, at, item_id, words`: each window with its rarest shingle, counted over all documents."""
    shingles = _shingles(windows, "words", width, "item_id", "words")
    wanted = stage(shingles.select("h").distinct(), "decontamination-shingles")
    seen = _shingles(documents, "words", width)
    found = [seen.join(F.broadcast(part), "h", "left_semi") for part in _blocks(wanted, blocks)]
    counts = reduce(DataFrame.unionByName, found).groupBy("h").agg(F.count("*").alias("n"))
    ranked = shingles.join(counts, "h", "left").fillna(0, ["n"])
    rarest = ranked.groupBy("item_id", "words").agg(F.min(F.struct("n", "h", "at")).alias("first"))
    return rarest.select("first.h", "first.at", "item_id", "words")


def _blocks(table: DataFrame, blocks: int) -> list[DataFrame]:
    return [table.where(F.pmod("h", F.lit(blocks)) == b) for b in range(blocks)] if blocks > 1 else [table]


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame | None:
    """`doc_id, text_hash, start, stop, item_id` of each window found; None without any window."""
    windows = stage(windows_of(items, window), "decontamination-windows")
    shortest, n = windows.agg(F.min(F.size("words")), F.sum(F.size("words"))).first()
    if not n:
        return None
    width, blocks = min(SHINGLE, shortest), -(-n // BLOCK_WORDS)
    documents = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of("text").alias("words"))
    first = stage(prefixes(documents, windows, width, blocks).withColumnsRenamed({"at": "_off", "words": "_window"}), "decontamination-prefixes")
    rows = _shingles(documents, "words", width, "doc_id", "text_hash", "words")
    start, length = F.col("at") - F.col("_off"), F.size("_window")
    found = []
    for part in _blocks(first, blocks):
        near = rows.join(F.broadcast(part), "h").where((start >= 0) & (start + length <= F.size("words")))
        same = near.where(F.slice("words", start + 1, length) == F.col("_window"))
        found.append(same.select("doc_id", "text_hash", start.alias("start"), (start + length).alias("stop"), "item_id"))
    return reduce(DataFrame.unionByName, found)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """`doc_id, n_words, n_hit, n_items, items_sha256, contaminated` of each row."""
    n_words = F.size(words_of("text")).cast("long")
    sizes = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), n_words.alias("n_words"))
    hits = benchmark_hits(docs, items, window)
    if hits is None:
        joined = sizes.select("*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    else:
        per_doc = hits.groupBy("doc_id", "text_hash").agg(
            F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
        )
        none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
        step = lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["upto"], s["start"]))).alias("n"),
            F.greatest(a["upto"], s["stop"]).alias("upto"),
        )
        covered = per_doc.select(
            F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"), "items",
            F.aggregate("spans", none, step)["n"].cast("long").alias("n_hit"),
        )
        on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
        joined = sizes.join(covered, on, "left").fillna(0, ["n_hit"])
        joined = joined.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "text_hash", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, items, window).where("contaminated").select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")
    ).distinct()
    on = docs["doc_id"].eqNullSafe(F.col("_doc_id")) & (F.xxhash64(docs["text"]) == F.col("_text_hash"))
    return docs.join(bad, on, "left_anti")


SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
i AS (
  SELECT coalesce(item_id::varchar, '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[p : p + {WINDOW - 1}] AS win FROM (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
runs AS (
  SELECT doc_id, p, n, w[p : p + n - 1] AS win FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, n, item_id FROM runs JOIN windows USING (win)),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

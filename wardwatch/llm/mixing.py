"""Mix sources to target weights by hash thresholds, without sorting rows.

Every document has a 32-bit hash of its id and text. Sizes are summed by source and hash bucket; the bucket in
which a source's budget is reached is found from these sums, and only that bucket is cut up again, by
the next bits of the hash, until the threshold is one hash value. A document is taken when its hash
lies below the threshold of its source. A larger budget only moves the threshold up, so the selections
of growing budgets are nested. Hot sources need nothing of their own: what is shuffled is sums, at most
one row per source, bucket and task.

Defined results: a null text has size 0; null sources form one source, the last; a null id hashes like
the empty text; rows of one id are drawn apart, and so are copies where a budget ends among them; an empty table gives an empty result. Only the
named columns are read, so further columns, whatever their names, do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardwatch.session import stage

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Bits of the hash that each histogram looks at, first to last.
LEVELS = (12, 10, 10)
HASH_BITS = sum(LEVELS)


def n_words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_digest(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A digest of id and text that every engine with md5 can compute, so that rows of one id are drawn apart."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))


def row_hash(digest: Column | str) -> Column:
    """32 bits of a digest: the first eight hex digits."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`source, source_size` to `source, source_size, target`.

    Weights repeat along the sources in code point order, null last. All sources share `share` times
    the whole size; none gets more than `most` times its own, and what it can't take goes to the others
    by weight. In order of cap over weight, the capped sources come first, so one pass of running sums
    finds them. The table has one row per source.
    """
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    weighed = totals.withColumn("_w", F.get(table, (F.row_number().over(listed) - 1) % len(weights)))
    weighed = weighed.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = weighed.withColumn("_level", left / F.sum("_w").over(rest))
    full = F.col("_level") > F.col("_cap") / F.col("_w")
    shared = F.first(F.when(~full, F.col("_level")), ignorenulls=True).over(whole)
    return level.select("source", "source_size", F.when(full, F.col("_cap")).otherwise(F.col("_w") * shared).alias("target"))


def _by_source(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join on source, null matching null, and on `names`; the keys are those of `left`."""
    keys = {name: f"_key_{name}" for name in ("source", *names)}
    right = right.withColumnsRenamed(keys)
    on = F.lit(True)
    for name, key in keys.items():
        on = on & F.col(name).eqNullSafe(F.col(key))
    return left.join(right, on, how).drop(*keys.values())


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """`source, source_size, target, times, cut, rest`: every document `times` times, and once more below `cut`.

    Of the rows whose hash is `cut`, `rest` words more are to be drawn. `sized` has `source, size, h`. Each level sums
    sizes inside the bucket that the level before found.
    """
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = targets.withColumn("times", times.cast("long")).select(
        "*", (F.col("target") - F.col("times") * F.col("source_size")).alias("want"), F.lit(0).cast("long").alias("prefix")
    )
    shift, levels = HASH_BITS, len(LEVELS)
    for number, bits in enumerate(LEVELS):
        prefix = F.shiftright("h", shift)
        shift -= bits
        inside = sized.withColumn("prefix", prefix).withColumn("bucket", F.shiftright("h", shift))
        if number:
            inside = _by_source(inside, state.select("source", "prefix"), "prefix", how="left_semi")
        sums = inside.groupBy("source", "bucket").agg(F.sum("size").alias("own"))
        upto = sums.withColumn("upto", F.sum("own").over(Window.partitionBy("source").orderBy("bucket")))
        reached = _by_source(upto, state).where(F.col("upto") >= F.col("want"))
        first = reached.groupBy("source").agg(F.min_by(F.struct(*[c for c in reached.columns if c != "source"]), "bucket").alias("at"))
        below = F.col("at.upto") - F.col("at.own")
        kept = [F.col(f"at.{c}").alias(c) for c in ("source_size", "target", "times")]
        if number < levels - 1:
            state = first.select("source", *kept, (F.col("at.want") - below).alias("want"), F.col("at.bucket").alias("prefix"))
        else:
            state = first.select("source", *kept, F.col("at.bucket").alias("cut"), (F.col("at.want") - below).alias("rest"))
    return state


def _drawn(docs: DataFrame, weights, share: float, most: float) -> DataFrame:
    """`doc_id, source, size, source_size, target, draws`, and the parts of its digest: how often each row is taken.

    The sizes are computed once and written to the shared folder; the passes after that read a few
    numbers per document.
    """
    digest = row_digest()
    part = F.spark_partition_id().alias("part")
    sized = docs.select("doc_id", "source", n_words("text").alias("size"), row_hash(digest).alias("h"), F.substring(digest, 9, 24).alias("rest_of_digest"), part)
    sized = stage(sized, "mix-sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    joined = _by_source(sized, stage(thresholds(sized, targets), "mix-thresholds"))
    names = ["doc_id", "source", "size", "source_size", "target", "h", "rest_of_digest"]
    apart = joined.where(F.col("h") != F.col("cut")).select(*names, (F.col("times") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0)).alias("draws"))
    return apart.unionByName(_boundary(joined.where(F.col("h") == F.col("cut"))).select(*names, "draws"))


def _boundary(rows: DataFrame) -> DataFrame:
    """`draws` of the rows whose hash is the threshold of their source: in order, as long as more than half of a row is wanted.

    These are few, or copies of one row, which all have one hash. Their running sizes are taken within the parts
    that were written, and over the sums of the parts, so that copies may be a third of all rows.
    """
    order = ["rest_of_digest", "doc_id"]
    own = F.sum("size").over(Window.partitionBy("source", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = sums.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_sum")
    joined = _by_source(rows.withColumn("_own", own), carried, "part")
    more = F.col("_before") + F.col("_own") - F.col("size") / 2 <= F.col("rest")
    return joined.withColumn("draws", F.col("times") + F.when(more, 1).otherwise(0))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`doc_id, source, size, source_size, target, taken`: what the mix takes of each document, in words."""
    drawn = _drawn(docs, weights, share, most)
    return drawn.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("draws")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The documents of which the mix takes words, with `size, source_size, target, taken`; columns of those names are replaced.

    Rows are matched by source and digest. Where copies of one row are drawn unequally often, because the threshold falls among
    them, the first ones of each task get the more; which they are makes no difference, as id and text are the same.
    """
    added = ("size", "source_size", "target", "taken")
    digest = row_digest()
    kinds = _drawn(docs, weights, share, most).groupBy("source", "h", "rest_of_digest")
    names = [F.first(c).alias(f"_{c}") for c in ("source_size", "target")]
    per_kind = kinds.agg(*names, F.min("draws").alias("_least"), F.sum("draws").alias("_all"), F.count(F.lit(1)).alias("_n"))
    per_kind = per_kind.withColumn("_more", F.col("_all") - F.col("_n") * F.col("_least")).drop("_all")
    rest = docs.select(*[c for c in docs.columns if c not in added])
    keyed = rest.select(
        F.struct(*rest.columns).alias("_row"), "source", n_words("text").alias("_size"), row_hash(digest).alias("h"), F.substring(digest, 9, 24).alias("rest_of_digest")
    )
    joined = _by_source(keyed, per_kind, "h", "rest_of_digest")
    # Only kinds that are drawn unequally are numbered: those at a threshold.
    even = joined.where("_more = 0").withColumn("_draws", F.col("_least"))
    place = F.row_number().over(Window.partitionBy("source", "h", "rest_of_digest").orderBy(F.lit(0)))
    odd = joined.where("_more > 0").withColumn("_draws", F.col("_least") + F.when(place <= F.col("_more"), 1).otherwise(0))
    mixed = even.unionByName(odd).select(
        "_row.*", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * F.col("_draws")).alias("taken"),
    )
    return mixed.where("taken > 0")


SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint AS size,
    md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) AS digest, ('0x' || digest[1:8])::bigint AS h FROM documents),
totals AS (SELECT source, sum(size)::bigint AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::double AS w, 2e0 * source_size AS cap FROM totals),
levelled AS (
  SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (
  SELECT source, source_size, CASE WHEN level > cap / w THEN cap
    ELSE w * (SELECT max_by(level, -cap / w) FROM levelled WHERE NOT level > cap / w) END AS target FROM levelled),
wanted AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::bigint ELSE 0 END AS times FROM targets),
reached AS (
  SELECT s.source, h, own, upto, target - times * source_size AS want FROM (
    SELECT source, h, own, sum(own) OVER (PARTITION BY source ORDER BY h) AS upto FROM (
      SELECT source, h, sum(size) AS own FROM sized GROUP BY ALL)) s
  JOIN wanted t ON s.source IS NOT DISTINCT FROM t.source WHERE upto >= target - times * source_size),
cuts AS (
  SELECT source, h AS cut, want - (upto - own) AS rest FROM reached QUALIFY row_number() OVER (PARTITION BY source ORDER BY h) = 1),
drawn AS (SELECT *, sum(size) OVER (PARTITION BY source, h ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING) AS run FROM sized)
SELECT doc_id, size, t.source_size, t.target,
  (size * (t.times + CASE WHEN h < c.cut OR (h = c.cut AND run - size / 2e0 <= c.rest) THEN 1 ELSE 0 END))::bigint AS taken
FROM drawn s JOIN wanted t ON s.source IS NOT DISTINCT FROM t.source JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""

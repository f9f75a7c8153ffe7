"""Comparing what was sent with what came out, and combining sets of events and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.session import stage

#: Each level of checksums divides a bucket by two to this power; one task hands on no more sums than that per open bucket.
LEVEL_BITS = 12
#: Numbers of open buckets up to here are sent to every task (8 bytes each); more are joined by shuffle.
MOST_SENT = 1_000_000


def combine_batches(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def missing_keys(sent: DataFrame, received: DataFrame, key: str = "event_id") -> DataFrame:
    """Sent keys that never came out."""
    return sent.select(key).distinct().join(received.select(key), key, "left_anti")


def reconcile(sent: DataFrame, received: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: sent, processed and missing keys, rows received twice, share processed.

    Each side is first reduced to one row per key, so a key that was sent or received very often
    does not grow the join.
    """
    left = sent.groupBy(key).agg(F.count(F.lit(1)).alias("_sent"))
    right = received.groupBy(key).agg(F.count(F.lit(1)).alias("_received"))
    both = left.join(right, key, "left")
    found = F.col("_received").isNotNull()
    totals = both.agg(
        F.count(F.lit(1)).alias("sent"),
        F.count_if(found).alias("processed"),
        F.count_if(~found).alias("missing"),
        F.coalesce(F.sum(F.greatest(F.col("_received") - F.col("_sent"), F.lit(0))), F.lit(0)).cast("bigint").alias("duplicates"),
    )
    share = F.coalesce(F.try_divide(F.col("processed").cast("double"), F.col("sent")), F.lit(0.0))
    return totals.withColumns({"success_rate": share, "all_processed": F.col("missing") == 0})


def _open_rows(rows: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the buckets whose checksums differ at every level, and rows counted by bucket of the first level."""
    a, b = F.xxhash64("_key", F.lit("sum")), F.xxhash64("_key", F.lit("xor"))
    sign = F.col("_sent") - F.col("_received")
    counted = None
    for level in range(1, levels + 1):
        rows = rows.withColumn("_bucket", F.xxhash64("_key").bitwiseAND(F.lit((1 << LEVEL_BITS * level) - 1)))
        sums = stage(
            rows.groupBy("_bucket").agg(
                F.sum("_sent").alias("_sent"),
                F.sum("_received").alias("_received"),
                F.sum(sign * a.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"),
                F.sum(sign * F.shiftrightunsigned(a, 32)).alias("_high"),
                F.bit_xor(b).alias("_xor"),
            ),
            "checksums",
        )
        counted = sums if counted is None else counted
        differ = sums.where("_sent <> _received OR _low <> 0 OR _high <> 0 OR _xor <> 0").select("_bucket")
        rows = rows.join(F.broadcast(differ) if differ.count() <= MOST_SENT else differ, "_bucket", "left_semi")
    return rows.drop("_bucket"), counted


def _tagged(sent: DataFrame, received: DataFrame, key: str) -> DataFrame:
    side = lambda df, s, r: df.select(F.col(key).alias("_key"), F.lit(s).cast("bigint").alias("_sent"), F.lit(r).cast("bigint").alias("_received"))
    return side(sent, 1, 0).unionByName(side(received, 0, 1))


def differing_keys(sent: DataFrame, received: DataFrame, key: str = "event_id", levels: int = 2) -> DataFrame:
    """Keys that were not received as often as sent, with both counts; null keys never match and are left out.

    Order-free checksums of hash buckets are compared first, a level at a time; only rows of buckets that
    differ are shuffled by key. What agrees costs one small row per bucket and task. Sets of keys that differ
    pass as equal only if 64 bits of summed hashes and 64 bits of another hash agree by chance.
    """
    opened, _ = _open_rows(_tagged(sent, received, key).where("_key IS NOT NULL"), levels)
    return _key_counts(opened).where("sent <> received").withColumnRenamed("_key", key)


def _key_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_key").agg(F.sum("_sent").alias("sent"), F.sum("_received").alias("received"))


def reconcile_by_checksum(sent: DataFrame, received: DataFrame, key: str = "event_id", levels: int = 2) -> DataFrame:
    """One row: rows sent and received, keys missing and unexpected, rows received twice, as `reconcile` has them.

    It is meant for large sides that differ in few keys (see `differing_keys`). A null key counts as a key that
    never matches. Empty sides give zeros.
    """
    rows = _tagged(sent, received, key)
    opened, counted = _open_rows(rows.where("_key IS NOT NULL"), levels)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    flag = lambda condition: F.when(condition, one).otherwise(zero)
    known = _key_counts(opened).select(
        zero.alias("sent_rows"),
        zero.alias("received_rows"),
        flag(F.expr("received = 0")).alias("missing"),
        flag(F.expr("sent = 0")).alias("unexpected"),
        F.when(F.expr("sent > 0"), F.greatest(F.col("received") - F.col("sent"), zero)).otherwise(zero).alias("duplicates"),
    )
    nulls = rows.where("_key IS NULL").agg(F.coalesce(F.sum("_sent"), zero).alias("s"), F.coalesce(F.sum("_received"), zero).alias("r"))
    nulls = nulls.select(F.col("s").alias("sent_rows"), F.col("r").alias("received_rows"), flag(F.col("s") > 0).alias("missing"), flag(F.col("r") > 0).alias("unexpected"), zero.alias("duplicates"))
    agreed = counted.select(F.col("_sent").alias("sent_rows"), F.col("_received").alias("received_rows"), zero.alias("missing"), zero.alias("unexpected"), zero.alias("duplicates"))
    every = known.unionByName(nulls).unionByName(agreed)
    totals = every.agg(*[F.sum(c).alias(c) for c in every.columns])
    return totals.withColumn("all_processed", F.col("missing") == 0)


def distinct_processed(received: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct patients in the output."""
    count = F.approx_count_distinct("patient_id") if approximate else F.count_distinct("patient_id")
    return received.agg(count.cast("bigint").alias("processed_patients"), F.count(F.lit(1)).alias("records"))


def metric_or(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All of `a`, and of `b` the rows whose keys `a` lacks."""
    return a.unionByName(b.join(a.select(*keys).distinct(), list(keys), "left_anti"))


def dedupe_events(df: DataFrame, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    return df.dropDuplicates(list(keys))

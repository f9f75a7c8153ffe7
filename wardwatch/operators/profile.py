"""A stored profile of the reference side of drift checks, so that a check reads the current side only.

A profile is one small table: for each number its bounds, deviation and counts by bin, for each text the count
of each value. It is written once per version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.operators import drift as D
from wardwatch.operators.ordered import ROWS_PER_CHUNK

COLUMNS = "kind string, column string, value double, text string, n bigint, low double, high double, spread double, bins int"


def _rows(df: DataFrame, kind: str, bins: int | None = None) -> DataFrame:
    made = {"kind": F.lit(kind), "bins": F.lit(bins)}
    fields = [field.split(" ") for field in COLUMNS.split(", ")]
    return df.select(*[(F.col(c) if c in df.columns else made.get(c, F.lit(None))).cast(t).alias(c) for c, t in fields])


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[D.known(F.col(c).cast("double")).alias(c) for c in columns]).unpivot([], list(columns), "column", "value")


def reference_profile(reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), bins: int = D.BINS) -> DataFrame:
    """The profile of these columns; numbers are read twice, for their bounds and for their bins.

    Nulls and NaNs are no values; a number without a value keeps a row of null bounds, and is not comparable later.
    """
    parts = []
    if numeric:
        long = _long(reference, numeric)
        moments = long.groupBy("column").agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.stddev_pop("value").alias("spread"))
        bounds = {r["column"]: (r.low, r.high) for r in moments.collect()}  # one row per column
        counts = long.where("value IS NOT NULL").withColumn("value", D.bin_middles(bounds, bins))
        parts += [_rows(moments, "number", bins), _rows(counts.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "bin")]
    if categorical:
        parts.append(_rows(D.category_frequencies(reference, categorical).withColumnRenamed("value", "text"), "category"))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both


def write_profile(profile: DataFrame, path: str, version: int) -> None:
    """A version written again replaces itself."""
    profile.write.mode("overwrite").parquet(f"{path}/version={version}")


def read_profile(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version, or the highest."""
    every = spark.read.parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version).drop("version")


def column_drift_from_profile(profile: DataFrame, current: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """What `column_drift` gives over bins, from a profile and the current rows."""
    numbers = profile.where("kind = 'number'").collect()  # one row per column
    texts = [r["column"] for r in profile.where("kind = 'category'").select("column").distinct().collect()]
    parts = []
    if numbers:
        bounds = {r["column"]: (r.low, r.high) for r in numbers}
        binned = _long(current, sorted(bounds)).where("value IS NOT NULL").withColumn("value", D.bin_middles(bounds, numbers[0].bins))
        zero = F.lit(0).cast("bigint")
        now = binned.groupBy("column", "value").agg(zero.alias("ref_n"), F.count(F.lit(1)).alias("cur_n"))
        before = profile.where("kind = 'bin'").select("column", "value", F.col("n").alias("ref_n"), zero.alias("cur_n"))
        counts = before.unionByName(now).groupBy("column", "value").agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
        spread = profile.where("kind = 'number'").select("column", F.col("spread").alias("_std"))
        parts.append(D.wasserstein_of(counts, spread, rows_per_chunk))
    if texts:
        before = profile.where("kind = 'category'").select("column", F.col("text").alias("value"), "n")
        parts.append(D.jensen_shannon_of(D.pairs_of(before, D.category_frequencies(current, sorted(texts)))))
    return D.judged(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))

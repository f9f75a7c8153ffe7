"""Small tables that a stream keeps whole, in a shared folder; `keyed` has those that grow.

A batch reads the newest complete version before its own and writes its own, so a replayed batch
gives the same table again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

VERSIONS_KEPT = 10


def folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def gone(path: str, before: int, there: list[int]) -> ValueError:
    return ValueError(f"{path}: no version before batch {before} is kept; the oldest is {min(there)}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    fs, target = folder(spark, path)
    if not fs.exists(target):
        return []
    done = []
    for entry in fs.listStatus(target):
        marker = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        name = entry.getPath().getName()
        if name.startswith("version=") and fs.exists(marker):
            done.append(int(name.removeprefix("version=")))
    return sorted(done)


def read_version(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The newest version, or the newest before a batch; an empty table where none was ever written.

    Where only later versions are left, as after a restart from an old checkpoint, going on with an
    empty table would lose all state, so that is an error.
    """
    there = versions(spark, path)
    found = [v for v in there if before is None or v < before]
    if not found and there and before and min(there) > 0:
        raise gone(path, before, there)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={found[-1]}")


def update_version(
    spark: SparkSession, path: str, schema: str, batch_id: int, merge: Callable[[DataFrame], DataFrame], keep: int = VERSIONS_KEPT
) -> None:
    """Write version `batch_id` as `merge(previous version)`, and drop versions too old to be read again."""
    merged = merge(read_version(spark, path, schema, before=batch_id))
    merged.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    fs, _ = folder(spark, path)
    for old in [v for v in versions(spark, path) if v <= batch_id][:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}"), True)

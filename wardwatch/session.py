"""Session settings and the shared folder for checkpoints and state."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Above this size the JVM does not compile a generated method; smaller methods are used instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # No record of the Python line behind each column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "wardwatch", master: str | None = None, parallelism: int | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings.

    `parallelism` is the number of shuffle partitions. A stream keeps the one that its first checkpoint
    was written with, so it is set before.
    """
    if parallelism is not None:
        conf["spark.sql.shuffle.partitions"] = str(parallelism)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder all executors share.

    A cluster names that folder in `spark.checkpoint.dir`. Where the setting is empty, a temporary
    folder takes its place if driver and executors are one process; elsewhere each machine would
    write to a disk of its own, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="wardwatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several branches read to the shared folder, and read it back.

    It is computed once, its row count comes from the file footers, and a lost executor costs no
    recomputation of what lies before it.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(module: str) -> None:
    """Send the functions of a module to Python workers whole, so that workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])

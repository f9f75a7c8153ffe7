"""From a table of documents to a training mix, in five stages.

1. `language`: documents whose language cannot be told (null, or without a letter) go.
2. `near_duplicates`: of each group of SimHash neighbours, the document with the smallest id stays.
3. `repeated_passages`: bytes under a 50-byte string of an earlier document are cut out of the text.
4. `benchmark`: contaminated documents go.
5. `mix`: sources are drawn to their target weights; a document may be taken more than once.

All but the last return the columns of `documents`. Each stage learns from and works on what the stage
before kept. `run` hands frames from stage to stage and lets each stage write what it reads twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.llm import decontamination, languages, mixing, simhash, suffix_dedup
from wardwatch.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages are learned from the labelled documents of four of five ids, as in the query of this operator."""
    numbered = docs.select(*docs.columns, F.struct(*docs.columns).alias("_row"))
    found = languages.identify(numbered, languages.remainder("doc_id", 5) != 0, ("_row",))
    return found.where(F.col("lang_pred") != languages.UNKNOWN).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_documents(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark", benchmark),
    ("mix", mix),
]
#: SQL cannot express the first three stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

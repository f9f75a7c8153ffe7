"""One registered query per operator, over the whole of its table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.llm import (
    conversations,
    decontamination,
    language_model,
    languages,
    licenses,
    mixing,
    neighbors,
    personal_data,
    simhash,
    substring_dedup,
    suffix_dedup,
    toxicity,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_mix_sources", mixing.SQL)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("source")


@query("op3_benchmark_decontamination", decontamination.SQL)
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.contamination(documents, benchmark).drop("text_hash")


@query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


@query("op2_license_scan", licenses.sql())
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_table(spark, sf_dir, "documents")).drop("text_hash")


@query("op9_nearest_neighbors")
def op9_nearest_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = languages.remainder("doc_id", 5) == 0
    documents = _table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    found = languages.identify(documents, ~F.col("held_out"), ("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "spans")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").withColumn("held_out", languages.remainder("doc_id", 5) == 0)
    return toxicity.toxicity(documents, _table(spark, sf_dir, "labels"), ~F.col("held_out"), ("doc_id", "held_out"))


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_words(_table(spark, sf_dir, "documents")).drop("kept")


@query("op7_suffix_array_dedup")
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_bytes(_table(spark, sf_dir, "documents"))


@query("op5_katz_language_model")
def op5_katz_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").withColumn("held_out", languages.remainder("doc_id", 10) == 0)
    return language_model.score_documents(documents, ~F.col("held_out"), ("doc_id", "held_out"))


@query("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.personal_data(_table(spark, sf_dir, "documents")))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations")))

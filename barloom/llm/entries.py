"""Queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import conversations, decontaminate, language, lloyd, minhash, packing, quality, secret_scan, shards, substring, token_files, toxicity, urls
from barloom.llm.oracle import oracle_sql  # noqa: F401
from barloom.sources.staging import work_path

TOKENIZER = os.environ.get("BARLOOM_TOKENIZER", "/opt/tokenizers/word_bpe_49k.json")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def tokenizer() -> str:
    try:
        import public_tokenizers
    except ImportError:
        return TOKENIZER
    return public_tokenizers.path("word_bpe_49k.json")


def op1_level_doubling(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.deduplicate(_documents(spark, folder))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    return quality.judge(docs, quality.fit(docs))


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digests(packing.pack(_documents(spark, folder), tokenizer()))


def op4_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.classes(_documents(spark, folder))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(_documents(spark, folder)))


def op6_path_templates(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{folder}/pages.parquet"))


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.assign(_documents(spark, folder), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "token-files")
    token_files.write(_documents(spark, folder), path, tokenizer())
    return token_files.digests(token_files.read(spark, path))


def op9_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_rank_order(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op12_sharded_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    return lloyd.with_inertia(*lloyd.cluster(spark.read.parquet(f"{folder}/embeddings.parquet")))


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    return conversations.digests(conversations.damage(rows), rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_level_doubling": op1_level_doubling,
        "op2_compression_bands": op2_compression_bands,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_dart_minhash": op4_dart_minhash,
        "op5_secret_scan": op5_secret_scan,
        "op6_path_templates": op6_path_templates,
        "op7_shards": op7_shards,
        "op8_token_files": op8_token_files,
        "op9_spaced_seeds": op9_spaced_seeds,
        "op10_toxicity": op10_toxicity,
        "op11_rank_order": op11_rank_order,
        "op12_sharded_lloyd": op12_sharded_lloyd,
        "op13_turn_repair": op13_turn_repair,
    }

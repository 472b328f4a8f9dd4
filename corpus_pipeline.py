"""From raw documents to packed training sequences.

Toxic documents go, one document of each near-duplicate class stays, documents that hold benchmark text go, secrets
are blotted out, and what is left is packed. Every stage reads the whole table that the stage before has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import decontaminate, entries, minhash, packing, secret_scan, toxicity
from barloom.sources.staging import write_shared


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels that are not held out."""
    return toxicity.keep(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each class of near duplicates."""
    return minhash.keep(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of a secret replaced by a mark, n_chars brought up to date."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 2048: one row per piece, as ``packing.pack`` returns it."""
    return packing.pack(docs, entries.tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: zstandard, hashing and tokenizers are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents below ``sf_dir``; each result but the last is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

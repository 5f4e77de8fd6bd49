"""The training corpus, stage by stage: quality, near copies, test passages, secrets, packing.

Each stage works on all that the one before has kept; what it decides takes effect. All but the last
return the columns of documents. The stages' rows are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import common, decontaminate, near_copies, ordinal_quality, packing, queries, secret_ledger, tokens
from tallyworks.sources import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of at least the second grade reaches a half."""
    model = ordinal_quality.learn(docs.select("doc_id", "text"), queries.ratings(spark, sf_dir))
    return ordinal_quality.score(docs, model).filter("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without those whose five-word shingles are similar (0.8 or more) to one that stays."""
    return near_copies.deduplicate(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in them replaced by a mark."""
    versions = docs.select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    ledger = secret_ledger.Ledger(spark, scratch.new_folder(spark, "ledger"))
    ledger.scan(versions)
    return ledger.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.digests(docs, tokens.public())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("packing", packed),
]

# SQL expresses neither the classifier nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return common.written(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])

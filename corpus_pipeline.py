"""The corpus pipeline: reject toxic documents, keep one of each near-duplicate group, remove
benchmark passages, redact secrets, and pack what is left into training sequences.

Each stage is written as Parquet and read again before the next. A stage takes documents with any
further columns, nulls in any column, repeated rows, and an empty table (which gives an empty one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from errata.llm import decontaminate, pack, secrets, simhash, toxicity
from errata.llm.common import forget, scratch, table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, learned from the labels that are not held out, is below the threshold.
    Null and empty texts stay."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def near_deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 0.8 of their five-word shingles, in chains: that
    of the least id. Null and empty texts are one group."""
    return simhash.deduplicate(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that benchmark items have too; those that are mostly such
    passages go. Null and empty texts stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark. Null texts stay null."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences. A null text is empty."""
    return pack.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", near_deduplicate),
    ("decontamination", remove_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]
#: The toxicity model is fitted by gradient descent, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage leaves in the shared folder is deleted once the next has
    read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            after = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        if before is not None:
            forget(before)
        docs = before = after
    return docs

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from errata.llm import ann, decontaminate, licenses, pack, pitman_yor, secrets, simhash, suffixes, toxicity, warc
from errata.llm.common import table
from errata.llm.sql import ORACLE_SQL


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens: a row for each piece. A null text is
    empty and a piece of its end alone."""
    return pack.pack(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licences, by name and place, and their differences in wording."""
    return licenses.report(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets, through a ledger that starts empty: all of its text is scanned."""
    known, ledger = secrets.update(table(spark, sf_dir, "documents"))
    return secrets.report(known, ledger)


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability, learned from the documents that are not held out."""
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; null and empty texts score 0."""
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share passages of 50 words or more with another row, and where."""
    return suffixes.report(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the least id of those that links lead to."""
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in windows of benchmark items, and the items."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest_match")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for each row whose id is divisible by 20."""
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.op1_warc,
    "op2_packing": op2_packing,
    "op3_licenses": op3_licenses,
    "op4_secrets": op4_secrets,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_toxicity": op6_toxicity,
    "op7_suffixes": op7_suffixes,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_neighbours": op10_neighbours,
}

__all__ = ["ORACLE_SQL", "QUERIES"]

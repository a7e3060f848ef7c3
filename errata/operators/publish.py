"""The published view and what is counted on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from errata.functions.text import blank_coalesce
from errata.schema import PUBLISHED

SHOWN = ("genuine_correction", "uncertain", "pending")


def published_view(raw: DataFrame) -> DataFrame:
    """The published rows, newest first: what is written or shown as a whole."""
    return published_rows(raw).orderBy(F.desc("date"), "url")


def published_rows(raw: DataFrame) -> DataFrame:
    """The 21 published columns of records whose status is shown (a missing one is pending), in no
    order: what searches, facets and pages start from."""
    status = F.coalesce("qa_status", F.lit("pending"))
    empty = F.lit("")
    derived = {
        "title": F.coalesce(blank_coalesce(F.col("headline"), F.col("title")), empty),
        "headline": F.coalesce(blank_coalesce(F.col("headline"), F.col("title")), empty),
        "correction": F.coalesce(blank_coalesce(F.col("correction_text_raw"), F.col("correction")), empty),
        "correction_text_raw": F.coalesce(blank_coalesce(F.col("correction_text_raw"), F.col("correction")), empty),
        "qa_status": status,
        "auto": F.coalesce("auto", F.lit(True)),
    }
    plain = {"id", "correction_date", "time_to_correct_hours"}
    columns = [derived[c].alias(c) if c in derived else F.col(c) if c in plain else F.coalesce(c, empty).alias(c) for c in PUBLISHED]
    return raw.filter(status.isin(*SHOWN)).select(*columns)


def status_counts(raw: DataFrame) -> DataFrame:
    status = F.coalesce("qa_status", F.lit("pending"))
    return raw.agg(*[F.count_if(status == s).alias(n) for s, n in (("genuine_correction", "genuine"), ("uncertain", "uncertain"), ("pending", "still_pending"), ("not_a_correction", "rejected"))], F.count("*").alias("total"))


def unknown_statuses(raw: DataFrame) -> DataFrame:
    """A data-quality check: statuses outside the enumeration, which the view drops."""
    known = (*SHOWN, "not_a_correction")
    return raw.filter(~F.coalesce("qa_status", F.lit("pending")).isin(*known)).groupBy("qa_status").agg(F.count("*").alias("n"))

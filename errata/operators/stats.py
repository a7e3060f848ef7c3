"""Aggregates over published corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from errata.functions.labels import TYPE_LABELS, label_of
from errata.functions.text import blank_coalesce, month_of, rounded


def monthly_counts(rows: DataFrame, stamp: Column) -> DataFrame:
    """month, n; rows without a valid time are left out."""
    return rows.select(month_of(stamp).alias("month")).filter("month IS NOT NULL").groupBy("month").agg(F.count("*").alias("n"))


def without_gaps(counts: DataFrame) -> DataFrame:
    """Every month from the first to the last, zero where there is none."""
    first = F.to_date(F.concat(F.min("month"), F.lit("-01")))
    last = F.to_date(F.concat(F.max("month"), F.lit("-01")))
    months = counts.agg(first.alias("a"), last.alias("b")).filter("a IS NOT NULL")
    spine = months.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("day")).select(F.date_format("day", "yyyy-MM").alias("month"))
    return spine.join(counts, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))


def monthly_durations(rows: DataFrame, stamp: Column, hours: Column) -> DataFrame:
    """month, avg_hours, median_hours (one decimal) and n of rows that have a duration. The median is
    exact: a task holds a month's distinct durations, of which two decimals and five years leave 4.4
    million at most, with their counts."""
    valid = rows.select(month_of(stamp).alias("month"), hours.alias("hours")).filter("month IS NOT NULL AND hours IS NOT NULL")
    return valid.groupBy("month").agg(rounded(F.avg("hours"), 1).alias("avg_hours"), rounded(F.median("hours"), 1).alias("median_hours"), F.count("*").alias("n"))


def type_breakdown(rows: DataFrame, code: Column, other: str = "other") -> DataFrame:
    """code, n, most frequent first; blank codes count as `other`."""
    named = rows.select(F.coalesce(blank_coalesce(code), F.lit(other)).alias("code"))
    return named.groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def with_share(counts: DataFrame, labels: dict[str, str] = TYPE_LABELS) -> DataFrame:
    """code, label, n, percent of all. The window is over the groups, of which there are few."""
    share = rounded(100 * F.col("n") / F.sum("n").over(Window.partitionBy())).cast("long")
    return counts.select("code", label_of(F.col("code"), labels, fallback=True).alias("label"), "n", share.alias("percent"))


def coverage(rows: DataFrame, column: Column) -> DataFrame:
    """with_value and total."""
    return rows.agg(F.count(column).alias("with_value"), F.count("*").alias("total"))


def facet(rows: DataFrame, column: Column) -> DataFrame:
    """The distinct values that are not blank, in order."""
    return rows.select(blank_coalesce(column).alias("value")).filter("value IS NOT NULL").distinct().orderBy("value")


def label_facet(rows: DataFrame, column: Column, labels: dict[str, str]) -> DataFrame:
    """The distinct codes that are not blank (value), their labels, and their place in the Norwegian
    order of labels, from 1. Codes are few: the window is over them alone."""
    values = rows.select(blank_coalesce(column).alias("value")).filter("value IS NOT NULL").distinct()
    named = values.withColumn("label", label_of(F.col("value"), labels, fallback=True))
    place = F.row_number().over(Window.orderBy(F.collate("label", "no"), "value"))
    return named.withColumn("place", place).orderBy("place")


def years(rows: DataFrame, stamp: Column) -> DataFrame:
    return rows.select(F.date_format(stamp, "yyyy").alias("value")).filter("value IS NOT NULL").distinct().orderBy(F.desc("value"))

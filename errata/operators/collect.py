"""From candidate addresses to new correction records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from errata.functions.lexicon import SECTIONS
from errata.functions.text import blank_coalesce, in_sections, iso_timestamp
from errata.schema import RAW_DDL
from errata.sources.connectors import PAGE_STEP


def unknown(candidates: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """Candidates whose key is not known. Null keys are unknown."""
    return candidates.join(known.select(key).distinct(), key, "left_anti")


def first_seen(candidates: DataFrame, key: str, *order: str) -> DataFrame:
    """Of each key the first row by the order and then by its other values, so that the result does not
    depend on how the rows lie; copies are cut before the shuffle."""
    given = {c for c in order if isinstance(c, str)}
    rest = [c for c, kind in candidates.dtypes if c not in given | {key} and "map<" not in kind and "variant" not in kind]
    turn = F.row_number().over(Window.partitionBy(key).orderBy(*order, *rest, F.lit(0)))
    return candidates.withColumn("errata_turn", turn).filter("errata_turn = 1").drop("errata_turn")


def recent(rows: DataFrame, as_of: datetime, days: int, *, lenient: bool, column: str = "lastmod") -> DataFrame:
    """Rows changed within `days` before as_of. Strict: after the cutoff, with a readable date.
    Lenient: at or after the cutoff, or without a readable date."""
    cutoff = F.lit(as_of) - F.make_dt_interval(F.lit(days))
    return rows.filter(is_recent(iso_timestamp(F.col(column)), cutoff, lenient=lenient))


def is_recent(stamp: Column, cutoff: Column, *, lenient: bool) -> Column:
    return (stamp.isNull() | (stamp >= cutoff)) if lenient else F.coalesce(stamp > cutoff, F.lit(False))


def search_requests(terms: DataFrame, pages: int) -> DataFrame:
    """(all columns of terms, page, offset): each term with its pages. `pages` is a small number."""
    return terms.select("*", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page")).withColumn("offset", F.col("page") * PAGE_STEP)


def up_to_last(results: DataFrame, key: str = "term", page: str = "page", more: str = "has_next") -> DataFrame:
    """Result pages up to and with the first of each key that has no next page."""
    last = results.groupBy(key).agg(F.min(F.when(~F.coalesce(F.col(more), F.lit(False)), F.col(page))).alias("errata_last"))
    return results.join(last, key).filter(F.col("errata_last").isNull() | (F.col(page) <= F.col("errata_last"))).drop("errata_last")


def sitemap_candidates(urls: DataFrame, known: DataFrame, as_of: datetime, days: int, *, lenient: bool, sections: tuple[str, ...] = SECTIONS) -> DataFrame:
    """New addresses of a sitemap: url, lastmod."""
    good = recent(urls.filter(in_sections(F.col("loc"), sections)), as_of, days, lenient=lenient)
    return unknown(first_seen(good.select(F.col("loc").alias("url"), "lastmod"), "url"), known)


def capped(rows: DataFrame, most: int, *order) -> DataFrame:
    """At most so many rows, the first by the order: the caps of a run (sitemaps, addresses)."""
    return rows.orderBy(*order).limit(most)


def records(found: DataFrame, source: str, ingested: datetime) -> DataFrame:
    """Raw records from url, title, published and correction; `date` falls back to the ingest time."""
    stamp = F.lit(ingested)
    return found.select(
        F.unix_millis(stamp).alias("id"),
        F.coalesce(blank_coalesce(F.col("published")), F.lit(ingested.isoformat())).alias("date"),
        "title",
        F.lit("Rettelse").alias("what"),
        F.col("correction").alias("correction_text_raw"),
        "correction",
        "url",
        F.lit(True).alias("auto"),
        F.lit(source).alias("source"),
        F.lit("pending").alias("qa_status"),
    )


def append(raw: DataFrame, new: DataFrame) -> DataFrame:
    """raw with the new records whose url it lacks, one of each: the least by id, date and the rest."""
    fresh = unknown(first_seen(new, "url", *[c for c in ("id", "date") if c in new.columns]), raw)
    return raw.unionByName(fresh, allowMissingColumns=True)


def empty_raw(spark) -> DataFrame:
    return spark.createDataFrame([], RAW_DDL)

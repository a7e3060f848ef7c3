"""The list: facets, free text, order and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from errata.functions.labels import CATEGORY_LABELS, TYPE_LABELS, label_of
from errata.functions.text import blank_coalesce, either, iso_timestamp

BATCH = 50
FIELDS = ("title", "correction", "what", "journalist", "correction_description", "correction_text_extract")


def matches(term: str, *columns: Column) -> Column:
    """Whether any of the columns contains the term, whatever the case."""
    return either(F.coalesce(F.contains(F.lower(c), F.lit(term.lower())), F.lit(False)) for c in columns)


def search(view: DataFrame, *, term: str = "", category: str = "", kind: str = "") -> DataFrame:
    """Rows of the facets (an empty one is no filter) that match the term in a text or a label."""
    out = view
    if category:
        out = out.filter(F.col("news_category") == category)
    if kind:
        out = out.filter(F.col("correction_type") == kind)
    if term:
        labels = (label_of(F.col("news_category"), CATEGORY_LABELS, fallback=False), label_of(F.col("correction_type"), TYPE_LABELS, fallback=False))
        out = out.filter(matches(term, *[F.col(c) for c in FIELDS if c in view.columns], *labels))
    return out


def ordered(view: DataFrame, by: str = "date_desc", *, tie: str = "url") -> DataFrame:
    """By date (invalid ones last) or, longest first, by the length of the correction."""
    if by == "correction_length":
        text = F.coalesce(blank_coalesce(F.col("correction_text_raw"), F.col("correction")), F.lit(""))
        return view.orderBy(F.desc(F.length(text)), tie)
    stamp = iso_timestamp(F.col("date"))
    return view.orderBy(stamp.asc_nulls_last() if by == "date_asc" else stamp.desc_nulls_last(), tie)


def page(rows: DataFrame, number: int, size: int = BATCH) -> DataFrame:
    """Page `number`, from 0, of ordered rows: a top-k, of all rows up to the page's end. For a list that
    is scrolled far, next_page() starts from what was shown last."""
    return rows.offset(number * size).limit(size) if number else rows.limit(size)


def next_page(view: DataFrame, date: str | None, url: str, size: int = BATCH) -> DataFrame:
    """The rows after the one of this date and url, newest first: a filter and a top-k of one page,
    however far down the list."""
    stamp, last = iso_timestamp(F.col("date")), iso_timestamp(F.lit(date))
    later = F.when(last.isNull(), stamp.isNull() & (F.col("url") > url)).otherwise(stamp.isNull() | (stamp < last) | ((stamp == last) & (F.col("url") > url)))
    return page(ordered(view.filter(later)), 0, size)


def shown_text(columns: tuple[str, ...] = ("correction_text_extract", "correction", "what")) -> Column:
    return F.coalesce(blank_coalesce(*[F.col(c) for c in columns]), F.lit(""))

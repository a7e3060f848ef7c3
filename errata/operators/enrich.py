"""Metadata, classification and durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from errata.functions.text import blank_coalesce, hours_between, json_object, without_fence
from errata.operators.collect import first_seen
from errata.schema import RESPONSE_FIELDS
from errata.sources.connectors import Classify, classified
from errata.sources.tables import stored_table

FILLED = ("headline", "nrk_section", "publication_date", "modified_date", "intro_text", "journalist", "responsible_editor", "article_body")
DEFAULTS = {"qa_status": "uncertain", "correction_description": "", "correction_text_extract": "", "correction_date": None, "news_category": "other", "correction_type": "other"}


def normalised(raw: DataFrame) -> DataFrame:
    """headline and correction_text_raw filled from title and correction where they are blank."""
    return raw.withColumns({"headline": blank_coalesce(F.col("headline"), F.col("title")), "correction_text_raw": blank_coalesce(F.col("correction_text_raw"), F.col("correction"))})


def pending(raw: DataFrame, limit: int = 450) -> DataFrame:
    """The newest pending records; a missing status is not pending. The limit is the batch size."""
    return raw.filter(F.col("qa_status") == "pending").orderBy(F.desc_nulls_last("date"), "url").limit(limit)


def filled(raw: DataFrame, found: DataFrame, columns: tuple[str, ...] = FILLED) -> DataFrame:
    """Blank columns filled from found (url and the columns): of several rows of a url the least, by
    the columns in order."""
    once = first_seen(found.select("url", *columns), "url", *columns).select("url", *[F.col(c).alias(f"errata_{c}") for c in columns])
    joined = raw.join(once, "url", "left")
    new = {c: F.coalesce(blank_coalesce(F.col(c), F.col(f"errata_{c}")), F.col(c), F.col(f"errata_{c}")) for c in columns}
    return joined.withColumns(new).select(*raw.columns)


def response_fields(text: Column) -> Column:
    """The answer's fields as a struct, or null if it is no JSON object."""
    value = json_object(without_fence(text))
    fields = [F.try_variant_get(value, f"$.{name}", "string").alias(name) for name in RESPONSE_FIELDS]
    return F.when(value.isNotNull(), F.struct(*fields))


def with_responses(raw: DataFrame, responses: DataFrame) -> DataFrame:
    """Records after classification by responses (url, response): those with a usable answer get its
    values or their defaults, names only if not blank; all others stay as they are, pending too. Of
    several answers for a url the least text counts."""
    answers = responses.groupBy("url").agg(F.min("response").alias("response")).select("url", response_fields(F.col("response")).alias("errata_answer"))
    joined = raw.join(answers, "url", "left")
    answer, has = F.col("errata_answer"), F.col("errata_answer").isNotNull()
    new = {c: F.when(has, F.coalesce(answer[c], F.lit(d).cast("string"))).otherwise(F.col(c)) for c, d in DEFAULTS.items()}
    new |= {c: F.when(has, F.coalesce(blank_coalesce(answer[c]), F.col(c))).otherwise(F.col(c)) for c in ("journalist", "responsible_editor")}
    return joined.withColumns(new).select(*raw.columns)


def with_durations(raw: DataFrame) -> DataFrame:
    """time_to_correct_hours of every record with a publication date: up to its modification or,
    without that, its correction date. Others keep what they have."""
    end = blank_coalesce(F.col("modified_date"), F.col("correction_date"))
    start = blank_coalesce(F.col("publication_date"))
    hours = F.when(start.isNotNull(), hours_between(start, end)).otherwise(F.col("time_to_correct_hours"))
    return raw.withColumn("time_to_correct_hours", hours)


def prompt(template: str, columns: tuple[str, ...]) -> Column:
    """A text from a template in which each %s stands for the next column; missing ones are empty."""
    return F.format_string(template, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def with_custom_fields(raw: DataFrame, responses: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Further fields of the answers (of several for a url, the least text), kept in the map column `extra`."""
    value = json_object(without_fence(F.col("response")))
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), F.try_variant_get(value, f"$.{n}", "string").alias("value")) for n in names])
    extra = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    answers = responses.groupBy("url").agg(F.min("response").alias("response")).select("url", extra.alias("errata_extra"))
    return raw.join(answers, "url", "left").withColumn("extra", F.coalesce("errata_extra", "extra")).select(*raw.columns)


def answer_pending(raw: DataFrame, prompt: Column, classify: Classify, answers: str, *, batch: int = 450, batches: int = 1, **options) -> DataFrame:
    """Ask for the pending records that have no answer yet, newest first, batch by batch; a batch's
    answers are appended to the Parquet table at `answers` before the next is asked for, so that a
    run that stops loses none. It ends with the batches, or with one that brings no answer (a lasting
    rate limit). Returns all answers: url, response."""
    spark, kind = raw.sparkSession, "url string, response string"
    known = stored_table(spark, answers, kind).count()
    for _ in range(batches):
        left = raw.join(stored_table(spark, answers, kind).select("url"), "url", "left_anti")
        asked = pending(left, batch).select("url", prompt.alias("prompt"))
        classified(asked, "prompt", classify, **options).filter("response IS NOT NULL").write.mode("append").parquet(answers)
        before, known = known, stored_table(spark, answers, kind).count()
        if known == before:
            break
    return stored_table(spark, answers, kind)

"""Queries of enrichment and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from errata.functions import text as fn
from errata.functions.labels import CATEGORY_LABELS, TYPE_LABELS, label_of
from errata.operators import enrich
from errata.plans import fixture as fx
from errata.plans.fixture import table
from errata.session import shared_path
from errata.streaming import stream

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def answers(spark, sf):
    """Answers in every shape: fenced, plain, broken, an array, without keys, with blank names."""
    n = F.col("doc_id")
    body = F.concat(F.lit('{"qa_status": "genuine_correction", "news_category": "sports", "journalist": "'), F.when(n % 2 == 0, "").otherwise("A B"), F.lit('", "correction_date": null}'))
    text = F.when(n % 5 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(n % 5 == 1, body).when(n % 5 == 2, "{broken").when(n % 5 == 3, "[1, 2]").otherwise("{}")
    return table(spark, sf, "documents").select("doc_id", F.concat(F.lit("u"), n.cast("string")).alias("url"), text.alias("response"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 IN (0, 1) THEN 'genuine_correction' WHEN doc_id % 5 = 4 THEN 'uncertain' ELSE 'pending' END AS qa_status,
  CASE WHEN doc_id % 5 IN (0, 1) THEN 'sports' WHEN doc_id % 5 = 4 THEN 'other' END AS news_category,
  CASE WHEN doc_id % 5 IN (0, 1, 4) THEN 'other' END AS correction_type,
  CASE WHEN doc_id % 5 IN (0, 1) AND doc_id % 2 = 1 THEN 'A B' ELSE 'before' END AS journalist, NULL::VARCHAR AS correction_date
FROM documents
""")
def llm_response_parse(spark, sf):
    found = answers(spark, sf)
    empty = {c: F.lit(None).cast("string") for c in ("correction_description", "correction_text_extract", "correction_date", "news_category", "correction_type", "responsible_editor")}
    raw = found.select("doc_id", "url", F.lit("pending").alias("qa_status"), F.lit("before").alias("journalist"), *[c.alias(n) for n, c in empty.items()])
    return enrich.with_responses(raw, found.select("url", "response")).select("doc_id", "qa_status", "news_category", "correction_type", "journalist", "correction_date")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE lang END AS headline, CASE WHEN doc_id % 4 = 0 THEN source ELSE 'kept' END AS journalist FROM documents")
def fill_if_blank(spark, sf):
    docs = table(spark, sf, "documents")
    url, n = F.col("doc_id").cast("string").alias("url"), F.col("doc_id")
    raw = docs.select("doc_id", url, F.when(n % 3 == 0, "").otherwise(F.col("lang")).alias("headline"), F.when(n % 4 != 0, "kept").alias("journalist"))
    found = docs.select(url, F.col("text").alias("headline"), F.col("source").alias("journalist"))
    return enrich.filled(raw, found, ("headline", "journalist")).select("doc_id", "headline", "journalist")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL
  ELSE round((epoch_us(o_orderdate::DATE + INTERVAL (CASE WHEN o_orderkey % 2 = 0 THEN 36 ELSE 5 END) HOUR) - epoch_us(o_orderdate)) / 3.6e9, 2) END AS hours FROM orders
""")
def iso_durations(spark, sf):
    n = F.col("o_orderkey")
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    day = F.date_add(F.to_date("o_orderdate"), 1)
    late = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T06:00:00+01:00"))
    end = F.when(n % 3 == 0, "garbage").when(n % 2 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(late)
    return table(spark, sf, "orders").select("o_orderkey", fn.hours_between(start, end).alias("hours"))


@query("""SELECT n_nationkey, '%22' || replace(n_name, ' ', '%20') || '%22' AS encoded FROM nation""")
def query_encoding(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", fn.quoted_query(F.col("n_name")).alias("encoded"))


@query(f"WITH {fx.RAW_SQL} SELECT id, {fx.sql_labels('news_category', CATEGORY_LABELS)} AS label, coalesce({fx.sql_labels('source', TYPE_LABELS)}, source) AS shown FROM raw")
def label_dimension(spark, sf):
    """A code's label, and a value without one as itself."""
    return fx.raw(spark, sf).select("id", label_of(F.col("news_category"), CATEGORY_LABELS, fallback=False).alias("label"), label_of(F.col("source"), TYPE_LABELS, fallback=True).alias("shown"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def stream_daily(spark, sf):
    """Daily counts in event time over a stream of the events, in complete mode."""
    folder = _folder(spark)
    events = table(spark, sf, "events").select("ts")
    events.write.parquet(f"{folder}/events")
    source = spark.readStream.schema(events.schema).parquet(f"{folder}/events")

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/counts")

    counts = stream.daily_counts(source)
    counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/counts")


def _folder(spark) -> str:
    return shared_path(spark, "stream")

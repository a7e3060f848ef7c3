"""Queries of the text predicates and rewrites, over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from errata.functions import text as fn
from errata.operators import maintain
from errata.plans import fixture as fx
from errata.plans.fixture import LEXICON, table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")




@query(f"SELECT doc_id FROM documents WHERE {fx.sql_trigger('text')}")
def trigger_filter(spark, sf):
    return docs(spark, sf).filter(fn.has_trigger(F.col("text"), LEXICON)).select("doc_id")


@query(f"SELECT doc_id, ({fx.sql_position('text')})::INT AS place FROM documents")
def trigger_position(spark, sf):
    return docs(spark, sf).select("doc_id", fn.trigger_position(F.col("text"), LEXICON).alias("place"))


@query(f"SELECT doc_id, {fx.sql_noise('text')} AS noise, length(text) BETWEEN 1 AND 2000 AND NOT {fx.sql_noise('text')} AS usable FROM documents")
def nav_noise_filter(spark, sf):
    text = F.col("text")
    return docs(spark, sf).select("doc_id", fn.is_noise(text, LEXICON).alias("noise"), fn.usable_block(text, LEXICON).alias("usable"))


@query(f"WITH p AS (SELECT doc_id, text, {fx.sql_position('text')} AS place FROM documents) SELECT doc_id, {fx.sql_trim('text', 'place')} AS trimmed FROM p")
def trim_to_trigger(spark, sf):
    return docs(spark, sf).select("doc_id", fn.trim_to_correction(F.col("text"), LEXICON).alias("trimmed"))


@query(f"SELECT doc_id, {fx.sql_starts('text')} AS starts FROM documents")
def starts_with_trigger(spark, sf):
    return docs(spark, sf).select("doc_id", fn.starts_with_trigger(F.col("text"), LEXICON).alias("starts"))


@query(f"SELECT doc_id, {fx.sql_complete('text')} AS complete FROM documents")
def looks_complete(spark, sf):
    return docs(spark, sf).select("doc_id", fn.looks_complete(F.col("text")).alias("complete"))


@query(f"SELECT doc_id FROM documents WHERE text = '' OR NOT {fx.sql_starts('text')} OR NOT {fx.sql_complete('text')}")
def needs_refetch(spark, sf):
    return docs(spark, sf).filter(fn.needs_refetch(F.col("text"), LEXICON)).select("doc_id")


NEW = "substring(text, (CASE WHEN doc_id % 2 = 0 THEN greatest(1, place) ELSE 1 END)::INT)"


@query(f"""
WITH p AS (SELECT doc_id, text, {fx.sql_position('text')} AS place FROM documents), n AS (SELECT doc_id, text, {NEW} AS new FROM p)
SELECT doc_id, CASE WHEN new <> '' AND (({fx.sql_starts('new')} AND NOT {fx.sql_starts('text')}) OR ({fx.sql_complete('new')} AND NOT {fx.sql_complete('text')})) THEN new ELSE text END AS text FROM n
""")
def better_text_upsert(spark, sf):
    base = docs(spark, sf)
    place = fn.trigger_position(F.col("text"), LEXICON)
    start = F.when(F.col("doc_id") % 2 == 0, F.greatest(F.lit(1), place)).otherwise(1)
    new = base.select("doc_id", F.substring(F.col("text"), start, F.length("text")).alias("new_text"))
    return maintain.upserted(base, new, "text", key="doc_id", lexicon=LEXICON)


@query("SELECT doc_id FROM documents WHERE NOT contains(text, 'rights reserved')")
def delete_placeholder(spark, sf):
    return maintain.without_placeholders(docs(spark, sf), "rights reserved", "text").select("doc_id")


@query(f"""
WITH p AS (SELECT doc_id, text, {fx.sql_position('text')} AS place FROM documents)
SELECT count(*) AS total, count(*) FILTER (({fx.sql_trim('text', 'place')}) <> text) AS changed FROM p
""")
def trim_changes(spark, sf):
    base = docs(spark, sf)
    return maintain.changes(base, maintain.trimmed(base, ("text",), LEXICON), "text", "doc_id")


@query("SELECT doc_id, text, 'pending' AS qa_status, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS nrk_section, NULL::DOUBLE AS time_to_correct_hours FROM documents")
def schema_evolution(spark, sf):
    old = table(spark, sf, "documents").select("doc_id", "text", F.nullif(F.col("lang"), F.lit("en")).alias("nrk_section"))
    return maintain.evolved(old, {"qa_status": ("string", "pending"), "nrk_section": ("string", "x"), "time_to_correct_hours": ("double", None)})



"""How the queries read the tables of the test data as corrections, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from errata.functions.labels import CATEGORY_LABELS, TYPE_LABELS
from errata.functions.lexicon import Lexicon

LEXICON = Lexicon(phrases=("licensed", "rights reserved"), bare=("license", "token"), good_starts=("licens", "token"), noise=("the ", "and ", "la ", "en "))
CATEGORIES = tuple(CATEGORY_LABELS)
TYPES = tuple(TYPE_LABELS)
SECTIONS = ("/en/", "/fr/")
SITE = "en.example.org"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code(values: tuple[str, ...], number):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw corrections; their labels give the status."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    n = F.col("doc_id")
    status = F.when(F.col("toxic") == 1, "not_a_correction").when(F.col("quality") == 1, "genuine_correction").when(F.col("quality").isNotNull(), "uncertain").when(n % 2 == 1, "pending")
    return docs.select(
        n.alias("id"),
        F.concat(F.lit("https://example.org/"), F.col("lang"), F.lit("/"), n.cast("string")).alias("url"),
        F.concat(F.lit("2024-01-"), F.lpad((n % 28 + 1).cast("string"), 2, "0")).alias("date"),
        F.col("text").alias("title"),
        F.when(n % 5 == 0, "").when(n % 7 != 0, F.upper("lang")).alias("headline"),
        F.lit(None).cast("string").alias("what"),
        F.when(n % 3 == 0, "").otherwise(F.col("text")).alias("correction_text_raw"),
        F.col("text").alias("correction"),
        F.lit(None).cast("string").alias("correction_description"),
        F.lit("").alias("correction_text_extract"),
        F.lit(None).cast("string").alias("correction_date"),
        status.alias("qa_status"),
        F.col("lang").alias("nrk_section"),
        F.lit("2024-01-01T00:00:00Z").alias("publication_date"),
        F.lit(None).cast("string").alias("modified_date"),
        code(CATEGORIES, n).alias("news_category"),
        code(TYPES, n).alias("correction_type"),
        F.lit(None).cast("string").alias("journalist"),
        F.lit(None).cast("string").alias("responsible_editor"),
        F.lit(None).cast("double").alias("time_to_correct_hours"),
        F.lit(None).cast("boolean").alias("auto"),
        "source",
    )


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


RAW_SQL = f"""
raw AS (
  SELECT d.doc_id AS id, 'https://example.org/' || d.lang || '/' || d.doc_id AS url,
    '2024-01-' || lpad((d.doc_id % 28 + 1)::VARCHAR, 2, '0') AS date, d.text AS title,
    CASE WHEN d.doc_id % 5 = 0 THEN '' WHEN d.doc_id % 7 <> 0 THEN upper(d.lang) END AS headline,
    CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE d.text END AS correction_text_raw, d.text AS correction,
    CASE WHEN l.toxic = 1 THEN 'not_a_correction' WHEN l.quality = 1 THEN 'genuine_correction'
      WHEN l.quality IS NOT NULL THEN 'uncertain' WHEN d.doc_id % 2 = 1 THEN 'pending' END AS qa_status,
    d.lang AS nrk_section, ({_list(CATEGORIES)})[d.doc_id % {len(CATEGORIES)} + 1] AS news_category,
    ({_list(TYPES)})[d.doc_id % {len(TYPES)} + 1] AS correction_type, d.source AS source
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
)"""


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as corrections of their orders: both times, and the order's codes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


DURATIONS_SQL = """
t AS (
  SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate, o_orderpriority,
    CASE WHEN epoch_us(l_shipdate) - epoch_us(o_orderdate) BETWEEN 0 AND 43800 * 3600000000
      THEN round((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9, 2) END AS hours
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


# ---- the text functions in SQL, for DuckDB ---------------------------------------------------------


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_labels(code: str, labels: dict[str, str]) -> str:
    return f"CASE {code} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in labels.items()) + " END"


def sql_trigger(text: str) -> str:
    return f"regexp_matches(lower({text}), {quoted(LEXICON.pattern)})"


def sql_noise(text: str) -> str:
    return "(" + " OR ".join(f"starts_with(lower({text}), {quoted(p)})" for p in LEXICON.noise) + ")"


def sql_phrase(lowered: str) -> str:
    places = ", ".join(f"nullif(strpos({lowered}, {quoted(p)}), 0)" for p in LEXICON.phrases)
    return f"coalesce(least({places}), 0)"


def sql_bare(lowered: str) -> str:
    pattern = LEXICON.bare_pattern
    before = f"regexp_extract({lowered}, {quoted('(?s)^(.*?)' + pattern)}, 0)"
    part = [f"regexp_extract({lowered}, {quoted(pattern)}, {i})" for i in (0, 2, 3)]
    return f"CASE WHEN {part[0]} = '' THEN 0 ELSE length({before}) - length({part[2]}) - length({part[1]}) + 1 END"


def sql_position(text: str) -> str:
    low = f"lower({text})"
    return f"CASE WHEN {sql_phrase(low)} > 0 THEN {sql_phrase(low)} ELSE {sql_bare(low)} END"


def sql_strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def sql_trim(text: str, place: str) -> str:
    """The trimmed text, given a column that holds the trigger's place."""
    chunk, tail = f"substring({text}, 1, {place} - 1)", f"substring({text}, {place})"
    capital = f"regexp_extract({chunk}, '(?s)\\.([A-ZÆØÅ][^.]*)$', 1)"
    cut = f"""CASE WHEN contains({chunk}, '. ') THEN regexp_extract({chunk}, '(?s)^.*\\. (.*)$', 1) || {tail}
      WHEN ends_with({chunk}, '.') THEN {tail} WHEN {capital} <> '' THEN {capital} || {tail}
      WHEN contains({chunk}, chr(10)) THEN regexp_extract({chunk}, '(?s)^.*\\n(.*)$', 1) || {tail} ELSE {text} END"""
    started = " OR ".join(f"starts_with(lower({text}), {quoted(p)})" for p in LEXICON.good_starts)
    return f"CASE WHEN ({started}) OR {place} = 0 THEN {text} ELSE coalesce(nullif({sql_strip(cut)}, ''), {text}) END"


def sql_starts(text: str) -> str:
    head = f"lower(substring({text}, 1, 80))"
    phrases = " OR ".join(f"strpos({head}, {quoted(p)}) BETWEEN 1 AND 50" for p in LEXICON.phrases)
    return f"({phrases} OR ({sql_bare(head)}) BETWEEN 1 AND 50)"


def sql_complete(text: str) -> str:
    stripped = rf"regexp_replace({text}, '\s+$', '')"
    return rf"""regexp_matches({stripped}, '([.!?)»"]|\d{{2}}\.\d{{2}}|\d{{4}})$')"""

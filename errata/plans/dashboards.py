"""Queries of the dashboards: counts, durations, shares, facets, search and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from errata.functions.labels import CATEGORY_LABELS, TYPE_LABELS
from errata.functions.text import duration_label, html_escape, iso_timestamp, long_date, valid_hours, year_of
from errata.operators import publish, search, stats
from errata.plans.fixture import DURATIONS_SQL, RAW_SQL, durations, raw, sql_labels, table
from errata.streaming.stream import daily_counts

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def hours():
    return valid_hours(F.col("o_orderdate"), F.col("l_shipdate"))


@query(f"WITH {DURATIONS_SQL} SELECT l_orderkey, l_linenumber, hours FROM t")
def time_to_correct(spark, sf):
    return durations(spark, sf).select("l_orderkey", "l_linenumber", hours().alias("hours"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def monthly_counts(spark, sf):
    return stats.monthly_counts(table(spark, sf, "orders"), F.col("o_orderdate"))


@query("""
WITH c AS (SELECT date_trunc('quarter', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT unnest(generate_series((SELECT min(m) FROM c)::TIMESTAMP, (SELECT max(m) FROM c)::TIMESTAMP, INTERVAL 1 MONTH)) AS m)
SELECT strftime(s.m, '%Y-%m') AS month, coalesce(n, 0)::BIGINT AS n FROM s LEFT JOIN c ON s.m = c.m
""")
def monthly_counts_gapfilled(spark, sf):
    """Orders by the first month of their quarter: two months of three are gaps."""
    return stats.without_gaps(stats.monthly_counts(table(spark, sf, "orders"), F.date_trunc("quarter", "o_orderdate")))


@query(f"""
WITH {DURATIONS_SQL}
SELECT strftime(l_shipdate, '%Y-%m') AS month, floor(avg(hours) * 10 + 0.5) / 10 AS avg_hours,
  floor(median(hours) * 10 + 0.5) / 10 AS median_hours, count(*) AS n FROM t WHERE hours IS NOT NULL GROUP BY 1
""")
def monthly_duration_avg_median(spark, sf):
    return stats.monthly_durations(durations(spark, sf), F.col("l_shipdate"), hours())


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def daily_event_counts(spark, sf):
    return daily_counts(table(spark, sf, "events").select("ts"))


@query("SELECT coalesce(nullif(o_orderpriority, ''), 'other') AS code, count(*) AS n FROM orders GROUP BY 1")
def type_breakdown(spark, sf):
    return stats.type_breakdown(table(spark, sf, "orders"), F.col("o_orderpriority"))


@query("SELECT coalesce(nullif(o_orderpriority, ''), 'other') AS code, count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND year(o_orderdate) = 1995 GROUP BY 1")
def type_breakdown_filtered(spark, sf):
    rows = table(spark, sf, "orders").filter((F.col("o_orderstatus") == "O") & (F.year("o_orderdate") == 1995))
    return stats.type_breakdown(rows, F.col("o_orderpriority"))


@query(f"""
WITH {RAW_SQL}, c AS (SELECT correction_type AS code, count(*) AS n FROM raw GROUP BY 1)
SELECT code, coalesce({sql_labels("code", TYPE_LABELS)}, code) AS label, n, floor(100 * n / sum(n) OVER () + 0.5)::BIGINT AS percent FROM c
""")
def type_share_pct(spark, sf):
    return stats.with_share(stats.type_breakdown(raw(spark, sf), F.col("correction_type")))


@query("SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority <> ''")
def facet_values(spark, sf):
    return stats.facet(table(spark, sf, "orders"), F.col("o_orderpriority"))


@query("SELECT DISTINCT strftime(o_orderdate, '%Y') AS value FROM orders")
def facet_years_desc(spark, sf):
    return stats.years(table(spark, sf, "orders"), F.col("o_orderdate"))


@query(f"""
WITH {RAW_SQL}, s AS (SELECT coalesce(qa_status, 'pending') AS s FROM raw)
SELECT count(*) FILTER (s = 'genuine_correction') AS genuine, count(*) FILTER (s = 'uncertain') AS uncertain,
  count(*) FILTER (s = 'pending') AS still_pending, count(*) FILTER (s = 'not_a_correction') AS rejected, count(*) AS total FROM s
""")
def status_counts(spark, sf):
    return publish.status_counts(raw(spark, sf))


@query(f"WITH {RAW_SQL} SELECT count(qa_status) AS with_value, count(*) AS total FROM raw")
def coverage(spark, sf):
    return stats.coverage(raw(spark, sf), F.col("qa_status"))


PUBLISHED_SQL = f"""
WITH {RAW_SQL}
SELECT id, url, date, coalesce(nullif(headline, ''), title) AS title, coalesce(nullif(headline, ''), title) AS headline,
  coalesce(nullif(correction_text_raw, ''), correction) AS correction, coalesce(nullif(correction_text_raw, ''), correction) AS correction_text_raw,
  '' AS correction_description, '' AS correction_text_extract, NULL::VARCHAR AS correction_date, coalesce(qa_status, 'pending') AS qa_status,
  nrk_section, '2024-01-01T00:00:00Z' AS publication_date, '' AS modified_date, news_category, correction_type, '' AS journalist,
  '' AS responsible_editor, NULL::DOUBLE AS time_to_correct_hours, TRUE AS auto, source
FROM raw WHERE coalesce(qa_status, 'pending') IN ('genuine_correction', 'uncertain', 'pending')
"""


@query(PUBLISHED_SQL)
def published_view(spark, sf):
    return publish.published_view(raw(spark, sf))


@query(f"WITH {RAW_SQL} SELECT id, url, date FROM raw WHERE qa_status = 'pending' ORDER BY date DESC, url LIMIT 450")
def pending_topk(spark, sf):
    from errata.operators.enrich import pending

    return pending(raw(spark, sf)).select("id", "url", "date")


SEARCHED = """lower(coalesce(title, '')) LIKE '%licens%' OR lower(coalesce(correction, '')) LIKE '%licens%'"""


@query(f"""
WITH v AS ({PUBLISHED_SQL})
SELECT id, url FROM v WHERE {SEARCHED} OR lower({sql_labels("news_category", CATEGORY_LABELS)}) LIKE '%licens%'
  OR lower({sql_labels("correction_type", TYPE_LABELS)}) LIKE '%licens%'
""")
def free_text_search(spark, sf):
    return search.search(publish.published_rows(raw(spark, sf)), term="Licens").select("id", "url")


@query(f"""
WITH v AS ({PUBLISHED_SQL})
SELECT id, url FROM v WHERE news_category = 'science' AND (lower({sql_labels("correction_type", TYPE_LABELS)}) LIKE '%feil%' OR lower(title) LIKE '%feil%' OR lower(correction) LIKE '%feil%')
""")
def search_with_facets(spark, sf):
    return search.search(publish.published_rows(raw(spark, sf)), term="feil", category="science").select("id", "url")


@query(f"WITH v AS ({PUBLISHED_SQL}) SELECT id, url, length(correction_text_raw)::INT AS size FROM v ORDER BY length(correction_text_raw) DESC, url LIMIT 50 OFFSET 50")
def list_sorted_page(spark, sf):
    rows = search.ordered(publish.published_rows(raw(spark, sf)), "correction_length")
    return search.page(rows, 1).select("id", "url", F.length("correction_text_raw").alias("size"))


@query(f"WITH v AS ({PUBLISHED_SQL}) SELECT id, url, date FROM v ORDER BY date, url LIMIT 50")
def list_oldest_page(spark, sf):
    return search.page(search.ordered(publish.published_rows(raw(spark, sf)), "date_asc"), 0).select("id", "url", "date")


@query(f"WITH v AS ({PUBLISHED_SQL}) SELECT id, url, date FROM v ORDER BY date DESC, url LIMIT 150 OFFSET 50")
def list_next_pages(spark, sf):
    """Three pages, each from where the one before ended: no page reads past what was shown."""
    view = publish.published_rows(raw(spark, sf))
    shown = search.page(search.ordered(view, "date_desc"), 0)
    pages = []
    for _ in range(3):
        last = shown.select("date", "url").tail(1)
        if not last:
            break
        shown = search.next_page(view, last[0]["date"], last[0]["url"])
        pages.append(shown)
    out = pages[0]
    for more in pages[1:]:
        out = out.unionByName(more)
    return out.select("id", "url", "date")


@query(f"WITH {RAW_SQL} SELECT id, coalesce(nullif(correction, ''), '') AS shown FROM raw")
def shown_text(spark, sf):
    return raw(spark, sf).select("id", search.shown_text().alias("shown"))


@query(f"""
WITH {DURATIONS_SQL}
SELECT l_orderkey, l_linenumber, CASE WHEN hours IS NULL THEN NULL WHEN hours < 1 THEN 'Under 1 time'
  WHEN hours < 24 THEN CASE WHEN floor(hours + 0.5) = 1 THEN '1 time' ELSE floor(hours + 0.5)::BIGINT || ' timer' END
  WHEN floor(hours / 24 + 0.5) = 1 THEN '1 dag' ELSE floor(hours / 24 + 0.5)::BIGINT || ' dager' END AS label FROM t
""")
def duration_bucket_label(spark, sf):
    return durations(spark, sf).select("l_orderkey", "l_linenumber", duration_label(hours()).alias("label"))


@query("""SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped FROM pages""")
def html_escaped(spark, sf):
    return table(spark, sf, "pages").select("page_id", html_escape(F.col("html")).alias("escaped"))


@query("""
SELECT o_orderkey, day(o_orderdate) || '. ' || (['januar', 'februar', 'mars', 'april', 'mai', 'juni', 'juli', 'august', 'september', 'oktober', 'november', 'desember'])[month(o_orderdate)]
  || ' ' || year(o_orderdate) AS shown, strftime(o_orderdate, '%Y') AS year FROM orders
""")
def long_dates(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", long_date(text).alias("shown"), year_of(iso_timestamp(text)).alias("year"))

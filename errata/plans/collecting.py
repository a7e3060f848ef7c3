"""Queries of collection: addresses, recency, anti-joins, paging, dead letters, streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from errata.functions import text as fn
from errata.operators import collect, extract, maintain
from errata.plans import fixture as fx
from errata.plans.fixture import LEXICON, SECTIONS, table
from errata.sources.html import parsed

QUERIES, ORACLE_SQL = {}, {}
AS_OF = datetime(2024, 1, 31)


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def pages(spark, sf):
    return table(spark, sf, "pages")


def known(spark, sf):
    return pages(spark, sf).filter("page_id % 3 = 0").select("url")


PATH = r"replace(replace(url, 'https://en.example.org/', ''), 'http://en.example.org/', '')"


@query(f"SELECT page_id, coalesce(nullif(CASE WHEN contains({PATH}, '/') THEN split_part({PATH}, '/', 1) ELSE split_part({PATH}, '?', 1) END, ''), 'ukjent') AS section FROM pages")
def url_section(spark, sf):
    return pages(spark, sf).select("page_id", fn.url_section(F.col("url"), fx.SITE).alias("section"))


@query("SELECT page_id, url FROM pages WHERE contains(url, '/en/') OR contains(url, '/fr/')")
def section_whitelist(spark, sf):
    return pages(spark, sf).filter(fn.in_sections(F.col("url"), SECTIONS)).select("page_id", "url")


LASTMOD_SQL = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END"


def stamped(spark, sf):
    ts = F.when(F.col("event_id") % 5 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, sf, "events").select("event_id", ts.alias("lastmod"))


@query(f"SELECT event_id FROM events WHERE date_trunc('second', {LASTMOD_SQL}) > TIMESTAMP '2024-01-31' - INTERVAL 20 DAY")
def recency_strict(spark, sf):
    return collect.recent(stamped(spark, sf), AS_OF, 20, lenient=False).select("event_id")


@query(f"SELECT event_id FROM events WHERE {LASTMOD_SQL} IS NULL OR date_trunc('second', ts) >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY")
def recency_lenient(spark, sf):
    return collect.recent(stamped(spark, sf), AS_OF, 20, lenient=True).select("event_id")


@query("SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def new_urls_antijoin(spark, sf):
    return collect.unknown(pages(spark, sf).select("page_id", "url"), known(spark, sf))


HREFS = r"""regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)"""


@query(f"SELECT page_id, unnest([replace(x, '&amp;', '&') for x in {HREFS}]) AS href FROM pages")
def page_links(spark, sf):
    return parsed(pages(spark, sf)).select("page_id", F.explode("page.links").alias("l")).select("page_id", F.col("l.href").alias("href"))


@query(f"""
WITH l AS (SELECT page_id, unnest([replace(x, '&amp;', '&') for x in {HREFS}]) AS href FROM pages)
SELECT href, min(page_id) AS page_id FROM l GROUP BY href
""")
def first_seen_dedup(spark, sf):
    links = parsed(pages(spark, sf)).select("page_id", F.posexplode("page.links").alias("pos", "l")).select("page_id", "pos", F.col("l.href").alias("href"))
    return collect.first_seen(links, "href", "page_id", "pos").select("href", "page_id")


ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))
HEADING = "regexp_extract(html, '<h1>([^<]*)</h1>', 1)"
for entity, character in ENTITIES:
    HEADING = f"regexp_replace({HEADING}, '{entity}?', '{character}', 'g')"  # a reference may lack its semicolon


@query(rf"SELECT page_id, substring(regexp_replace({HEADING}, '^\s+|\s+$', '', 'g'), 1, 200) AS title FROM pages")
def page_title(spark, sf):
    return parsed(pages(spark, sf)).select("page_id", extract.page_title(F.col("page")).alias("title"))


@query("""
WITH r AS (SELECT user_id AS term, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS page, event_type <> 'error' AS has_next FROM events),
l AS (SELECT term, min(page) FILTER (NOT has_next) AS last FROM r GROUP BY term)
SELECT term, page::INT AS page, has_next FROM r JOIN l USING (term) WHERE last IS NULL OR page <= last
""")
def search_pages_cutoff(spark, sf):
    rows = table(spark, sf, "events").selectExpr("user_id AS term", "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS page", "event_type <> 'error' AS has_next")
    return collect.up_to_last(rows).select("term", "page", "has_next")


@query("SELECT r_name AS term, p::INT AS page, (p * 20)::INT AS \"offset\" FROM region, range(3) t(p)")
def search_requests(spark, sf):
    return collect.search_requests(table(spark, sf, "region").select(F.col("r_name").alias("term")), 3)


LETTERS = "SELECT 'u' || event_id AS url, 'e' || (event_id % 7) AS error, (event_id % 7)::INT AS retry_count FROM events WHERE event_type = 'error' OR event_id % 11 = 0"
KNOWN = "SELECT 'u' || event_id AS url FROM events WHERE event_id % 4 = 0"
FAILED = "SELECT 'u' || event_id AS url, 'again' AS error FROM events WHERE event_id % 3 = 0"


@query(f"""
WITH d AS ({LETTERS}), m AS (SELECT d.*, d.url NOT IN ({KNOWN}) AND retry_count < 5 AS tried, d.url IN (SELECT url FROM ({FAILED})) AS failed FROM d)
SELECT url, error, (retry_count + CASE WHEN tried THEN 1 ELSE 0 END)::INT AS retry_count, CASE WHEN tried THEN 'again' END AS last_error,
  CASE WHEN tried THEN '2024-02-01' END AS last_retry, retry_count + CASE WHEN tried THEN 1 ELSE 0 END >= 5 AS exhausted
FROM m WHERE NOT tried OR failed
""")
def dead_letter_retry(spark, sf):
    events = table(spark, sf, "events")
    url = F.concat(F.lit("u"), F.col("event_id").cast("string"))
    letters = events.filter("event_type = 'error' OR event_id % 11 = 0").select(
        url.alias("url"), F.concat(F.lit("e"), (F.col("event_id") % 7).cast("string")).alias("error"), (F.col("event_id") % 7).cast("int").alias("retry_count"), F.lit(None).cast("string").alias("last_error"), F.lit(None).cast("string").alias("last_retry")
    )
    known_urls = events.filter("event_id % 4 = 0").select(url.alias("url"))
    failed = maintain.to_retry(letters, known_urls).join(events.filter("event_id % 3 = 0").select(url.alias("url")), "url").select("url", F.lit("again").alias("error"))
    return maintain.after_retry(letters, known_urls, failed, "2024-02-01")


NODE = "x"
for entity, character in (("&copy;", "©"), ("&middot;", "·"), *ENTITIES):
    NODE = f"regexp_replace({NODE}, '{entity}?', '{character}', 'g')"
BODY = rf"""array_to_string([y FOR y IN [regexp_replace({NODE}, '^\s+|\s+$', '', 'g') FOR x IN string_split_regex(regexp_extract(html, '(?s)<article>(.*?)(</article>|$)', 1), '<[^>]*>')] IF y <> ''], ' ')"""


# Of an article every part behind a <p> is a paragraph: up to its </p> or, if it has none, to the end.
# An end tag closes the paragraph begun last; what is unclosed goes on around those that follow.
JOINED = rf"""array_to_string([regexp_replace({NODE}, '^\s+|\s+$', '', 'g') FOR x IN string_split_regex(%s, '<[^>]*>')], '')"""
BLOCKS = f"""
a AS (SELECT page_id, url, html, string_split(regexp_extract(html, '(?s)<article>(.*?)(</article>|$)', 1), '<p>')[2:] AS parts FROM pages),
m AS (SELECT page_id, 1 AS pass, i, CASE WHEN contains(parts[i], '</p>') THEN split_part(parts[i], '</p>', 1) ELSE array_to_string(parts[i:], '<p>') END AS markup FROM a, unnest(range(1, len(parts) + 1)) AS u(i)
  UNION ALL SELECT page_id, 3, 1, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) FROM pages),
t AS (SELECT page_id, pass, i, {JOINED % "markup"} AS t FROM m),
g AS (SELECT page_id, pass, i, t, {fx.sql_position("t")} AS place FROM t WHERE length(t) BETWEEN 1 AND 2000 AND NOT {fx.sql_noise("t")} AND {fx.sql_trigger("t")}),
f AS (SELECT page_id, i, {fx.sql_trim("t", "place")} AS t FROM g WHERE pass = 1 OR page_id NOT IN (SELECT page_id FROM g WHERE pass = 1)),
k AS (SELECT page_id, i, t FROM f WHERE NOT EXISTS (SELECT 1 FROM f AS o WHERE o.page_id = f.page_id AND contains(o.t, f.t) AND (length(o.t) > length(f.t) OR (length(o.t) = length(f.t) AND o.i < f.i)))),
c AS (SELECT page_id, string_agg(t, ' | ' ORDER BY length(t) DESC, i) AS correction FROM k GROUP BY page_id)
"""
PAGE_TEXT = f"(SELECT {NODE} FROM (SELECT regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', '', 'g') AS x))"


@query(rf"""
WITH {BLOCKS}
SELECT url, substring(regexp_replace({HEADING}, '^\s+|\s+$', '', 'g'), 1, 200) AS title, '' AS published, correction FROM c JOIN pages USING (page_id) WHERE {fx.sql_trigger(PAGE_TEXT)}
""")
def correction_blocks(spark, sf):
    """Extraction from raw pages, whose paragraphs are in part unclosed."""
    return extract.detect(parsed(pages(spark, sf)), LEXICON)


@query(rf"""
SELECT page_id, substring(regexp_replace({HEADING}, '^\s+|\s+$', '', 'g'), 1, 300) AS headline, split_part(url, '/', 1) AS nrk_section, '' AS publication_date, '' AS modified_date,
  '' AS intro_text, '' AS journalist, '' AS responsible_editor, substring({BODY}, 1, 20000) AS article_body FROM pages WHERE url IS NOT NULL
""")
def article_metadata(spark, sf):
    return parsed(pages(spark, sf).filter("url IS NOT NULL")).select("page_id", extract.metadata(F.col("page"), F.col("url")).alias("m")).select("page_id", "m.*")

"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from errata.llm import warc
from errata.llm.secrets import BASE, RULES

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _matches(number: int, rule) -> str:
    """start and size of a rule's matches: what lies between matches gives their places."""
    p = _quoted(rule.pattern)
    return f"""
  SELECT doc_id, {number} AS kind, '{rule.kind}' AS name, start, start + size AS "end" FROM (
    SELECT doc_id, (coalesce(list_sum([length(x) for x in gaps[1:k]]), 0) + coalesce(list_sum([length(x) for x in found[1:k - 1]]), 0))::BIGINT AS start,
      length(found[k]) AS size, length(own[k]) AS own
    FROM (SELECT doc_id, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}, 0) AS found, regexp_extract_all(t, {p}, {rule.group}) AS own FROM d),
      unnest(range(1, len(found) + 1)) AS u(k)
  ) WHERE own >= {rule.least}"""


_NAMES = ", ".join(f"'{r.kind}'" for r in BASE)
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_matches(i, r) for i, r in enumerate(RULES))}),
s AS (
  SELECT doc_id, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access, count(*) FILTER (name = 'hex') AS n_hex,
    string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) FILTER (name IN ({_NAMES})) AS base,
    string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) AS spans, count(*) AS n_spans
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN s USING (doc_id)
"""

_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
# The longest match of a document is that of any run of words that an item has, of at least a window.
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, {_WORD}) AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER}, {_WORD}) AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win FROM i, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(p) WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win FROM d, k, unnest(range(1, len(w) - k + 2)) AS u(p)),
h AS (SELECT DISTINCT doc_id, p, k, item FROM dw JOIN iw USING (k, win)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, p, k FROM h), unnest(range(p, p + k)) AS u(q) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

# Rows are told apart by a number, whatever their ids are.
SUFFIXES = rf"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
r AS (SELECT n, p, md5(array_to_string(w[p:p + 49], ' ')) AS run FROM d, unnest(range(1, len(w) - 48)) AS u(p)),
s AS (SELECT run FROM r GROUP BY run HAVING min(n) < max(n)),
f AS (SELECT n, p, CASE WHEN p <= lag(p) OVER (PARTITION BY n ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM r JOIN s USING (run)),
g AS (SELECT n, p, sum(new) OVER (PARTITION BY n ORDER BY p) AS span FROM f),
e AS (SELECT n, min(p) - 1 AS a, max(p) + 49 AS b FROM g GROUP BY n, span),
t AS (SELECT n, sum(b - a)::BIGINT AS covered, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM e GROUP BY n)
SELECT d.doc_id, len(w)::BIGINT AS n_words, covered AS n_repeated, spans FROM d JOIN t USING (n)
"""

ORACLE_SQL = {"op1_warc": warc.ORACLE_SQL, "op4_secrets": SECRETS, "op7_suffixes": SUFFIXES, "op9_decontamination": DECONTAMINATION}

"""The registered queries and their SQL: QUERIES and ORACLE_SQL have the same keys, but for queries
that SQL can't express, which have none."""

from __future__ import annotations

from errata.plans import articles, collecting, dashboards, enriching, texts

QUERIES = {**dashboards.QUERIES, **texts.QUERIES, **collecting.QUERIES, **enriching.QUERIES, **articles.QUERIES}
ORACLE_SQL = {**dashboards.ORACLE_SQL, **texts.ORACLE_SQL, **collecting.ORACLE_SQL, **enriching.ORACLE_SQL, **articles.ORACLE_SQL}

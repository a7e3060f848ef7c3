"""Every registered query of the library against its SQL, over the small tables."""

import os

import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
OWN = [q for q in entry_module.queries() if not q.startswith("op") and q != "pipeline"]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(value):
    if value is None or value != value:
        return ""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(round(float(value), 6))
    return str(value)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    rows = entry_module.queries()[name](spark, SF)
    got = sorted(tuple(plain(v) for _, v in sorted(r.asDict().items())) for r in rows.collect())
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert rows.columns
        return
    base = duckdb.connect()
    for t in TABLES:
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = base.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(rows.columns)
    order = sorted(range(len(columns)), key=columns.__getitem__)
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in found.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_stream_again_adds_nothing(spark, tmp_path):
    from datetime import datetime

    from errata.streaming import stream

    folder = f"file://{tmp_path}"
    page = [(1, "https://x/a", "<p>NRK retter: A.</p>"), (2, "https://x/b", "<p>ingen</p>")]
    spark.createDataFrame(page, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages")

    def run(checkpoint):
        stream.collect_stream(stream.page_stream(spark, f"{folder}/pages"), f"{folder}/raw", f"{folder}/{checkpoint}", source="sitemap", ingested=datetime(2024, 1, 1)).awaitTermination()

    run("c1")
    run("c1")
    run("c2")
    assert spark.read.parquet(f"{folder}/raw").count() == 1


def test_a_stream_stopped_by_its_time_budget_goes_on(spark, tmp_path):
    from datetime import datetime

    from errata.streaming import stream

    folder = f"file://{tmp_path}"
    pages = [(i, f"https://x/{i}", f"<p>NRK retter: sak {i}.</p>") for i in range(12)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4).write.parquet(f"{folder}/pages")

    def run():
        return stream.collect_stream(stream.page_stream(spark, f"{folder}/pages"), f"{folder}/raw", f"{folder}/c", source="sitemap", ingested=datetime(2024, 1, 1))

    ended = [stream.within(run(), 0.01), stream.within(run(), 300)]
    assert ended == [False, True]
    assert sorted(r.url for r in spark.read.parquet(f"{folder}/raw").collect()) == sorted(u for _, u, _ in pages)


def test_pages_are_dealt_to_as_many_files_as_they_have_parts(spark, tmp_path):
    from datetime import datetime

    from errata.streaming import stream

    folder = f"file://{tmp_path}"
    row = ["id AS page_id", "'https://x/' || id AS url", "'<p>NRK retter: sak ' || id || '.</p>' AS html"]
    for parts in (1, 6):
        pages = spark.range(0, 600, 1, parts).selectExpr(*row)
        at_once = stream.deal(pages, f"{folder}/pages{parts}", 3)
        files = list((tmp_path / f"pages{parts}").glob("part-*.parquet"))
        assert (at_once, len(files)) == (parts, 3 * parts)
        assert max(spark.read.parquet(f"file://{f}").count() for f in files) < 300 / parts
        running = stream.collect_stream(stream.page_stream(spark, f"{folder}/pages{parts}", files_at_once=at_once), f"{folder}/raw{parts}", f"{folder}/c{parts}", source="sitemap", ingested=datetime(2024, 1, 1))
        running.awaitTermination()
        assert [p["batchId"] for p in running.recentProgress if p["numInputRows"]] == [0, 1, 2]
        assert spark.read.parquet(f"{folder}/raw{parts}").select("url").distinct().count() == spark.read.parquet(f"{folder}/raw{parts}").count() == 600

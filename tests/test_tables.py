import json
from datetime import datetime

from pyspark.sql import functions as F

from errata.operators import collect, enrich, maintain, publish, search, stats
from errata.schema import PUBLISHED, RAW_DDL
from errata.sources import connectors, tables


def raw(spark, *rows):
    names = [c.split()[0] for c in RAW_DDL.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW_DDL)


def test_published(spark):
    view = publish.published_view(
        raw(
            spark,
            {"url": "a", "date": "2024-01-01", "title": "T", "headline": "", "correction": "C", "correction_text_raw": None},
            {"url": "b", "date": "2024-01-02", "qa_status": "not_a_correction"},
            {"url": "c", "date": "2024-01-03", "qa_status": "genuine_correction", "auto": False, "headline": "H", "title": "T"},
            {"url": "d", "qa_status": "strange"},
            {"url": "e", "date": None, "qa_status": "uncertain"},
        )
    )
    assert view.columns == list(PUBLISHED)
    rows = view.collect()
    assert [r.url for r in rows] == ["c", "a", "e"]
    assert (rows[1].title, rows[1].correction, rows[1].qa_status, rows[1].auto, rows[0].auto) == ("T", "C", "pending", True, False)
    assert publish.unknown_statuses(raw(spark, {"url": "d", "qa_status": "strange"})).collect()[0].n == 1


def test_month_gaps_and_median(spark):
    counts = spark.createDataFrame([("2024-01", 2), ("2024-04", 1)], "month string, n long")
    assert [tuple(r) for r in stats.without_gaps(counts).orderBy("month").collect()] == [("2024-01", 2), ("2024-02", 0), ("2024-03", 0), ("2024-04", 1)]
    assert stats.without_gaps(counts.limit(0)).count() == 0
    rows = spark.createDataFrame([("2024-01-05", h) for h in (1.0, 2.0, 10.0, 20.0, None)], "d string, h double")
    found = stats.monthly_durations(rows, F.to_timestamp("d"), F.col("h")).collect()
    assert [tuple(r) for r in found] == [("2024-01", 8.3, 6.0, 4)]


def test_breakdown(spark):
    rows = spark.createDataFrame([("a",), ("",), (None,), ("a",), ("wrong_name",)], "t string")
    shares = stats.with_share(stats.type_breakdown(rows, F.col("t"))).collect()
    assert {r.code: (r.label, r.n, r.percent) for r in shares} == {"a": ("a", 2, 40), "other": ("Annet", 2, 40), "wrong_name": ("Feil navn", 1, 20)}


def test_responses(spark):
    table = raw(spark, *[{"url": str(i), "qa_status": "pending", "journalist": "før"} for i in range(5)])
    answers = spark.createDataFrame(
        [("0", '```json\n{"qa_status":"genuine_correction","journalist":" "}\n```'), ("1", "{}"), ("2", "[1]"), ("3", "broken"), ("4", '{"journalist":"","news_category":"crime"}')], "url string, response string"
    )
    got = {r.url: (r.qa_status, r.news_category, r.journalist) for r in enrich.with_responses(table, answers).collect()}
    assert got["0"] == ("genuine_correction", "other", " ")
    assert got["1"] == ("uncertain", "other", "før")
    assert got["2"] == got["3"] == ("pending", None, "før")
    assert got["4"] == ("uncertain", "crime", "før")


def test_fill_durations_pending(spark):
    table = raw(spark, {"url": "a", "headline": "", "publication_date": "2024-01-01T00:00:00Z", "correction_date": "2024-01-02"}, {"url": "b", "headline": "H", "time_to_correct_hours": 3.0, "date": "2024-02-01", "qa_status": "pending"})
    found = spark.createDataFrame([("a", "N"), ("a", "N"), ("b", "M")], "url string, headline string")
    assert {r.url: r.headline for r in enrich.filled(table, found, ("headline",)).collect()} == {"a": "N", "b": "H"}
    assert {r.url: r.time_to_correct_hours for r in enrich.with_durations(table).collect()} == {"a": 36.0, "b": 3.0}
    assert [r.url for r in enrich.pending(table).collect()] == ["b"]


def test_recency(spark):
    rows = spark.createDataFrame([("new", "2024-01-30"), ("edge", "2024-01-01"), ("old", "2023-01-01T00:00:00Z"), ("none", None), ("bad", "x")], "loc string, lastmod string")
    as_of = datetime(2024, 1, 31)
    assert {r[0] for r in collect.recent(rows, as_of, 30, lenient=False).collect()} == {"new"}
    assert {r[0] for r in collect.recent(rows, as_of, 30, lenient=True).collect()} == {"new", "edge", "none", "bad"}


def test_dead_letters(spark):
    letters = spark.createDataFrame([("a", "e", "t", 0, None, None), ("b", "e", "t", 4, None, None), ("c", "e", "t", 5, None, None), ("d", "e", "t", None, None, None), ("k", "e", "t", 1, None, None)], tables.DEAD_LETTER_DDL)
    known = spark.createDataFrame([("k",)], "url string")
    assert {r.url for r in maintain.to_retry(letters, known).collect()} == {"a", "b", "d"}
    failed = spark.createDataFrame([("b", "x"), ("d", "y")], "url string, error string")
    after = {r.url: (r.retry_count, r.last_error, r.exhausted) for r in maintain.after_retry(letters, known, failed, "now").collect()}
    assert after == {"b": (5, "x", True), "c": (5, None, True), "d": (1, "y", False), "k": (1, None, False)}


def test_maintenance(spark):
    table = spark.createDataFrame([("a", "feil"), ("b", None), ("c", "Rettelsestekst ikke tilgjengelig")], "url string, correction_text_raw string")
    assert {r.url for r in maintain.without_placeholders(table).collect()} == {"a", "b"}
    new = spark.createDataFrame([("a", "nrk retter feil."), ("b", "")], "url string, new_text string")
    assert {r.url: r.correction_text_raw for r in maintain.upserted(table, new, "correction_text_raw").collect()}["a"] == "nrk retter feil."
    assert maintain.evolved(table, {"qa_status": ("string", "pending"), "url": ("string", "x")}).first().qa_status == "pending"


def test_search(spark):
    view = publish.published_view(raw(spark, {"url": "a", "title": "Om SPORT", "date": "2024-01-02", "news_category": "crime", "correction": "lang tekst"}, {"url": "b", "title": "x", "date": "bad", "news_category": "sports", "correction": "kort"}))
    assert {r.url for r in search.search(view, term="sport").collect()} == {"a", "b"}
    assert [r.url for r in search.search(view, term="sport", category="crime").collect()] == ["a"]
    assert [r.url for r in search.ordered(view).collect()] == ["a", "b"]
    assert [r.url for r in search.page(search.ordered(view, "correction_length"), 1, 1).collect()] == ["b"]


def test_next_pages(spark):
    view = spark.createDataFrame([(f"u{i:02}", None if i % 7 == 0 else f"2024-01-{i % 5 + 1:02}") for i in range(40)], "url string, date string")
    whole = [(r.url, r.date) for r in search.ordered(view).collect()]
    got = [(r.url, r.date) for r in search.page(search.ordered(view), 0, 9).collect()]
    while more := [(r.url, r.date) for r in search.next_page(view, got[-1][1], got[-1][0], 9).collect()]:
        got += more
    assert got == whole


def test_paging(spark):
    rows = spark.createDataFrame([("t", 0, True), ("t", 1, False), ("t", 2, True), ("u", 0, True), ("u", 1, True)], "term string, page int, has_next boolean")
    assert sorted((r.term, r.page) for r in collect.up_to_last(rows).collect()) == [("t", 0), ("t", 1), ("u", 0), ("u", 1)]


def test_json_and_sitemap(spark, tmp_path):
    path = tmp_path / "raw.json"
    assert tables.json_table(spark, f"file://{path}").count() == 0
    path.write_text(json.dumps([{"url": "a", "title": "T"}, {"url": "b", "extra": {"k": "v"}}]))
    assert tables.json_table(spark, f"file://{path}").count() == 2
    site = tmp_path / "s.xml"
    site.write_text('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://www.nrk.no/sport/a</loc><lastmod>2024-01-01</lastmod></url><url><loc>b</loc></url></urlset>')
    assert sorted((r.loc, r.lastmod) for r in tables.sitemap_urls(spark, f"file://{site}").collect()) == [("b", None), ("https://www.nrk.no/sport/a", "2024-01-01")]
    stored = f"file://{tmp_path}/t"
    tables.replace(spark.range(3), stored)
    tables.replace(tables.stored_table(spark, stored, "id long").filter("id > 0"), stored)
    assert tables.stored_table(spark, stored, "id long").count() == 2


def test_retry():
    waits, answers = [], [(429, ""), (503, ""), (200, "x")]
    assert connectors.with_retry(lambda _: answers.pop(0), "u", sleep=waits.append) == (200, "x")
    assert waits == [3.0, 3.0]
    waits.clear()
    assert connectors.with_retry(lambda _: (403, ""), "u", sleep=waits.append) == (403, "")
    assert waits == [3.0, 6.0]


def test_connectors(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    got = {r.url: (r.status, r.html, r.error) for r in connectors.fetched(urls, lambda u: (200, f"<p>{u}</p>") if u == "a" else (404, "gone")).collect()}
    assert got == {"a": (200, "<p>a</p>", None), "b": (404, None, None)}
    asked = connectors.classified(urls.coalesce(1).withColumn("p", F.col("url")), "p", lambda p: "{}" if p == "a" else connectors.RATE_LIMITED, sleep=lambda _: None).collect()
    assert [r.response for r in asked] == ["{}", None, None]


def test_an_address_of_several_pages(spark):
    pages = spark.createDataFrame([(0, "a", "<p>0</p>"), (1, "a", "<p>1</p>"), (3, "a", "<p>3</p>"), (6, None, "<p>6</p>"), (9, "b", None), (9, "c", "<p>9</p>"), (9, "c", "<p>9</p>"), (None, "a", "x")], "page_id long, url string, html string")
    kept = pages.filter("page_id % 3 = 0")
    got = [(r.url, r.status, r.html) for r in connectors.fetched_from(pages, kept, "page_id").collect()]
    assert sorted(got, key=str) == sorted([("a", 200, "<p>0</p>"), ("a", 404, None), ("a", 200, "<p>3</p>"), (None, 200, "<p>6</p>"), ("b", 200, None), ("c", 200, "<p>9</p>"), ("c", 200, "<p>9</p>"), ("a", 404, None)], key=str)
    assert sorted((r.url, r.status, r.html) for r in connectors.fetched_from(pages.filter("url IS NOT NULL"), kept).collect()) == [("a", 200, "<p>0</p>"), ("b", 200, None), ("c", 200, "<p>9</p>")]


def test_rate_limits_are_waited_for():
    waits, answers = [], [connectors.RATE_LIMITED] * 2 + ["{}"]
    assert connectors._asked(lambda _: answers.pop(0), "p", connectors.WAITS, waits.append) == "{}"
    assert waits == [60.0, 120.0]
    waits.clear()
    assert connectors._asked(lambda _: connectors.RATE_LIMITED, "p", connectors.WAITS, waits.append) == connectors.RATE_LIMITED
    assert waits == [60.0, 120.0, 180.0]


def test_search_ends_without_a_next_page(spark):
    seen = {"x": 3, "y": 1, "z": 0}

    def search(address):
        term, start = address.split("q=%22")[1].split("%22")[0], int(address.rsplit("=", 1)[1])
        more = "<a>Neste side</a>" if start // 20 + 1 < seen[term] else ""
        return f"<p>{term}{start}</p>{more}" if seen[term] else None

    terms = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3), (None, 4)], "term string, rank int")
    got = sorted((r.term, r.page, r.offset, r["rank"]) for r in connectors.searched(terms, search).collect())
    assert got == [("x", 0, 0, 1), ("x", 1, 20, 1), ("x", 2, 40, 1), ("y", 0, 0, 2)]
    assert connectors.searched(terms, search, pages=2).filter("term = 'x'").count() == 2


def test_a_replaced_table_always_has_a_version(spark, tmp_path):
    """A run that breaks off before the pointer moves leaves the table as it was; old versions go."""
    path = f"file://{tmp_path}/t"
    tables.replace(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/version-broken")
    assert tables.stored_table(spark, path, "id long").count() == 3
    reading = tables.stored_table(spark, path, "id long")
    tables.replace(reading.filter("id > 0"), path)
    assert reading.count() == 3 and tables.stored_table(spark, path, "id long").count() == 2
    tables.replace(spark.range(7), path)
    assert tables.stored_table(spark, path, "id long").count() == 7
    assert len(list((tmp_path / "t").glob("version-*"))) == 2


def test_json_arrays_and_dated_export(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Rød", None), (2, 'a "b"\nc', 1.5)], "id int, title string, x double")
    tables.write_array(rows.repartition(2), f"file://{tmp_path}/a")
    parts = [json.loads(p.read_text(encoding="utf-8")) for p in (tmp_path / "a").glob("part-*")]
    assert sorted((x["id"], x["title"], x["x"]) for part in parts for x in part) == [(1, "Rød", None), (2, 'a "b"\nc', 1.5)]
    tables.write_array(rows.limit(0), f"file://{tmp_path}/none")
    assert tables.json_table(spark, f"file://{tmp_path}/none", "id int").count() == 0
    path = tables.export_dated(rows, f"file://{tmp_path}", datetime(2024, 3, 9).date())
    assert path.endswith("/rettelser-2024-03-09.json")
    (file,) = (tmp_path / "rettelser-2024-03-09.json").glob("part-*")
    assert file.read_text(encoding="utf-8").startswith('[\n  {\n    "id": ') and len(json.loads(file.read_text(encoding="utf-8"))) == 2

def test_an_array_is_read_by_ranges_of_bytes(spark, tmp_path):
    """Records are whole wherever a range ends, whatever they hold; files that others wrote are read too."""
    schema = "id long, t string, a array<string>, o array<struct<p:int>>"
    texts = [None, "]", "a\n  },\n  {\nb", "},", "æøå", ""]
    rows = [(i, texts[i % 6], [None, [], ["]"]][i % 3], [[(1,), (2,)], None][i % 2]) for i in range(200)]
    records = [{"id": i, "t": t, "a": a, "o": o and [{"p": p} for (p,) in o]} for i, t, a, o in rows]
    tables.write_array(spark.createDataFrame(rows, schema).coalesce(1), f"file://{tmp_path}/own")
    for indent in (None, 1, 2, 4):
        (tmp_path / f"by{indent}").write_text(json.dumps(records, indent=indent, ensure_ascii=False), encoding="utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size, names in ((1009, ("own", "by2")), (331, ("by2",)), (100_000, ("own", "byNone", "by1", "by2", "by4"))):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            for name in names:
                read = tables.json_table(spark, f"file://{tmp_path}/{name}", schema)
                assert sorted((r.asDict(True) for r in read.collect()), key=lambda r: r["id"]) == records
                assert size > 2000 or read.rdd.getNumPartitions() > 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    (tmp_path / "broken").write_text('[\n  {\n    "id": 1\n  },\n  {\n    "id": x\n  }\n]')
    assert [r.id for r in tables.json_table(spark, f"file://{tmp_path}/broken", schema).collect()] == [1, None]


def test_a_dated_export_is_written_by_many_tasks(spark, tmp_path):
    """One file, in the order of the rows, of which no task writes all; a second export takes its place."""

    def by_task(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([TaskContext.get().partitionId()] * batch.num_rows, pa.int32())], ["id", "task"])

    rows = spark.range(0, 40, 1, 4).filter("id NOT BETWEEN 10 AND 19").mapInArrow(by_task, "id long, task int")
    for df, ids in ((rows, [*range(10), *range(20, 40)]), (rows.filter("id > 35"), [36, 37, 38, 39]), (rows.limit(0), [])):
        path = tables.export_dated(df, f"file://{tmp_path}", datetime(2024, 3, 9).date())
        (file,) = (tmp_path / "rettelser-2024-03-09.json").glob("part-*")
        text = file.read_text(encoding="utf-8")
        assert text == json.dumps([{"id": i, "task": i // 10} for i in ids], indent=2) + "\n"
        assert sorted(r.id for r in tables.json_table(spark, path, "id long", required=True).collect()) == ids
        assert [x.name for x in tmp_path.iterdir()] == ["rettelser-2024-03-09.json"]


def test_counters(spark):
    counted, seen = tables.counting(spark.range(10), "c", even=F.col("id") % 2 == 0)
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_choices_do_not_depend_on_how_rows_lie(spark):
    rows = [("u", f"t{i}") for i in range(40)]
    for df in (spark.createDataFrame(rows, "url string, lastmod string").repartition(n) for n in (1, 7)):
        assert collect.first_seen(df, "url").first().lastmod == "t0"
        assert collect.first_seen(df, "url", F.desc("lastmod")).first().lastmod == "t9"
        assert [r.lastmod for r in collect.capped(df, 2, F.desc("lastmod")).collect()] == ["t9", "t8"]
    table = spark.createDataFrame([("a", "feil")], "url string, text string")
    new = spark.createDataFrame([("a", "nrk retter x.", 1), ("a", "nrk retter b.", 2)], "url string, new_text string, turn int")
    assert maintain.upserted(table, new, "text", order="turn").first().text == "nrk retter b."
    assert maintain.upserted(table, new, "text").first().text == "nrk retter x."


def test_answers_are_kept_when_a_run_stops(spark, tmp_path):
    """A classifier that breaks down after some batches: what it has answered is there, and is not asked again."""
    table = raw(spark, *[{"url": f"u{i}", "date": f"2024-01-{i:02}", "qa_status": "pending"} for i in range(1, 10)])
    folder = f"file://{tmp_path}/answers"
    got = enrich.answer_pending(table, F.col("url"), lambda u: "{}" if int(u[1:]) > 4 else connectors.RATE_LIMITED, folder, batch=2, batches=9, sleep=lambda _: None)
    assert {r.url for r in got.collect()} == {"u9", "u8", "u7", "u6", "u5"}
    got = enrich.answer_pending(table, F.col("url"), lambda u: "{}" if int(u[1:]) < 5 else "[]", folder, batch=9, sleep=lambda _: None)
    assert got.filter("response = '[]'").count() == 0 and got.count() == 9


def test_facet_order(spark):
    rows = spark.createDataFrame([("weather",), ("economy",), ("world",), ("",), (None,), ("crime",), ("economy",)], "c string")
    labels = {"weather": "Vær", "economy": "Økonomi", "world": "Utenriks", "crime": "Ås"}
    assert [(r.value, r.place) for r in stats.label_facet(rows, F.col("c"), labels).collect()] == [("world", 1), ("weather", 2), ("economy", 3), ("crime", 4)]

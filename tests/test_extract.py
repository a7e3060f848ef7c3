from datetime import datetime

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from errata.operators import extract
from errata.operators.collect import append, records
from errata.schema import RAW_DDL
from errata.sources.html import PIECE, in_pieces, parsed, read_page


def pages(spark, *html):
    return parsed(spark.createDataFrame([(f"https://www.nrk.no/sport/{i}", h) for i, h in enumerate(html)], "url string, html string"))


def found(spark, html, **options):
    return pages(spark, html).select(extract.correction_text(F.col("page"), **options)).first()[0]


def test_passes(spark):
    assert found(spark, "<p>NRK retter: A.</p><div>NRK retter: B.</div>") == "NRK retter: A."
    assert found(spark, "<div>NRK retter: B.</div>") == "NRK retter: B."
    assert found(spark, "<div><p>x</p>NRK retter: B.</div>") is None
    assert found(spark, "<aside>Boks. NRK retter: lang tekst.</aside><blockquote>NRK retter: annet.</blockquote>") == "NRK retter: lang tekst. | NRK retter: annet."
    assert found(spark, "<aside><p>NRK retter: A.</p></aside>") == "NRK retter: A."
    assert found(spark, "<p>Hei. NRK retter: A.</p>", trim=False) == "Hei. NRK retter: A."


def test_text_rules(spark):
    assert found(spark, "<p>NRK <b>retter</b> feil</p>") is None
    assert found(spark, "<p>" + "x" * 1990 + " rettelse</p>") is not None
    assert found(spark, "<p>" + "x" * 1992 + " rettelse</p>") is None
    assert found(spark, "<p>Hopp til innhold rettelse</p>") is None
    assert found(spark, "<script>var a='<p>nrk retter</p>'</script><p>tom</p>") is None
    assert found(spark, "<p>først<p>NRK retter: A.</p>") is not None
    assert found(spark, "") is None
    assert found(spark, None) is None


def test_dedup(spark):
    df = spark.createDataFrame([(["abc", "abcdef", "abc"],), (["bb NRK retter", "aaa NRK retter"],), ([],)], "b array<string>")
    assert [r[0] for r in df.select(extract.distinct_blocks(F.col("b"))).collect()] == [["abcdef"], ["aaa NRK retter", "bb NRK retter"], []]


def test_title_and_date(spark):
    rows = pages(
        spark,
        "<h1> Tittel <i>to</i></h1><title>x</title><time datetime='2024-01-01'>i dag</time>",
        "<title>Sak – NRK</title><meta property='article:published_time' content='2024-02-02'>",
        "<p>ingen</p>",
    ).select(extract.page_title(F.col("page")).alias("t"), extract.published(F.col("page")).alias("d"))
    assert [tuple(r) for r in rows.collect()] == [("Tittelto", "2024-01-01"), ("Sak", "2024-02-02"), ("", "")]


def test_metadata(spark):
    page = """<html><head><meta property="og:title" content=" Stor sak "><meta property="og:title" content="annen">
    <meta property="article:published_time" content="2024-01-01T10:00:00Z"><meta property="og:description" content="Ingress">
    <script type="application/ld+json">{"author": [{"name": " Kari Nordmann "}]}</script></head>
    <body><article><p>Brød <b>tekst</b></p></article><p>Ansvarlig redaktør: Ola Nordmann</p></body></html>"""
    plain = '<h1>Overskrift</h1><div class="my-Byline x">Per Hansen</div><script type="application/ld+json">{broken</script>'
    rows = pages(spark, page, plain, '<script type="application/ld+json">[{"author": {"name": "Liv"}}]</script>').select(extract.metadata(F.col("page"), F.col("url")).alias("m")).select("m.*").collect()
    assert (rows[0].headline, rows[0].nrk_section, rows[0].publication_date, rows[0].modified_date, rows[0].intro_text) == ("Stor sak", "sport", "2024-01-01T10:00:00Z", "", "Ingress")
    assert (rows[0].journalist, rows[0].responsible_editor, rows[0].article_body) == ("Kari Nordmann", "Ola Nordmann", "Brød tekst")
    assert (rows[1].headline, rows[1].journalist) == ("Overskrift", "Per Hansen")
    assert rows[2].journalist == "Liv"


def test_standalone(spark):
    html = "<main>" + "".join(f"<p>Et avsnitt nummer {i} som er langt nok</p>" for i in range(8)) + "<p>kort</p></main>"
    text = pages(spark, html).select(extract.standalone_text(F.col("page"))).first()[0]
    assert text.count("avsnitt") == 6
    assert pages(spark, "<p>Et avsnitt som er langt nok, uten beholder</p>").select(extract.standalone_text(F.col("page"))).first()[0] is None


def test_links(spark):
    site = "https://www.nrk.no/"
    html = f'<a href="{site}sport/a">A</a><a href="{site}sok/sport/">S</a><a href="{site}">R</a><a href="https://x.no/sport/b">X</a><a href="{site}blogg/c">C</a><a>Neste side</a>'
    page = pages(spark, html)
    assert [r.href for r in extract.candidate_links(page).collect()] == [site + "sport/a"]
    assert page.select(extract.has_next(F.col("page"))).first()[0]


def test_collect_twice(spark):
    raw = spark.createDataFrame([], RAW_DDL)
    hits = extract.detect(pages(spark, "<p>NRK retter: A.</p>", "<p>ingenting</p>", "<p>Rettelse: B</p>"))
    new = records(hits, "search", datetime(2024, 1, 1))
    once = append(raw, new)
    assert once.count() == 2
    assert append(once, new).count() == 2


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>/pdiv =\"'ab&;!-", max_size=60))
def test_any_markup_is_read(html):
    page = read_page(html)
    assert set(page) >= {"page_text", "blocks"}


def test_pages_are_read_in_pieces():
    """Of a large batch a few pages are held at a time; all of them come out, in order."""
    pages = [f"<article><p>{i} {'ord ' * 20_000}</p></article>" for i in range(100)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"n": list(range(102)), "html": pages})
    pieces = list(in_pieces(iter([batch, batch.slice(0, 0), batch.slice(100)]), ["n"], "html"))
    assert [n for piece in pieces for n in piece.column("n").to_pylist()] == [*range(102), 100, 101]
    assert max(piece.nbytes for piece in pieces) < 2 * PIECE < len("".join(pages[:100]))
    assert all(p["page_text"].startswith(f"{n} ord") for piece in pieces for n, p in zip(*piece.to_pydict().values()) if n < 100)


def test_pieces_count_the_text_of_unclosed_links_and_paragraphs():
    """A small page can hold far more text than markup: an unclosed element has all the text behind it."""
    page = '<a href="x">' + "<p>et avsnitt" * 300 + "</a>"
    batch = pa.RecordBatch.from_pydict({"n": list(range(60)), "html": [page] * 60})
    pieces = list(in_pieces(iter([batch]), ["n"], "html"))
    assert sum(piece.num_rows for piece in pieces) == 60
    assert max(piece.nbytes for piece in pieces) < 3 * PIECE < sum(piece.nbytes for piece in pieces)

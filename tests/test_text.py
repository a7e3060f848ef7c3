import pytest
from pyspark.sql import functions as F

from errata.functions import text as fn
from errata.functions.labels import TYPE_LABELS, label_of


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, function, inputs):
    rows = [(i, x) for i, x in enumerate(inputs)]
    out = spark.createDataFrame(rows, "i int, x string").select("i", function(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(out, key=lambda r: r["i"])]


def test_trigger(spark):
    cases = {"NRK retter: feil navn": True, "henrettelse": False, "feilretting": False, "henrettelse: i dag": True, "Retting av prøver": True, "Rettelser:": False, "RETTELSEN": False, "": False, "ørettelse": False}
    assert one(spark, fn.has_trigger, list(cases)) == list(cases.values())


def test_trim(spark):
    cases = {
        "Rettelser: X": "Rettelser: X",
        " abc ": " abc ",
        "Ingress her. NRK retter: navnet var feil.": "NRK retter: navnet var feil.",
        "En dom. Så kom retting av prøver. NRK beklager dette.": "NRK beklager dette.",
        "kroner.Rettelse: 5": "Rettelse: 5",
        "Bilde av X.Artikkelen NRK beklager feilen": "Artikkelen NRK beklager feilen",
        "Linje en\nher er i en tidligere versjon": "her er i en tidligere versjon",
        "  blah NRK retter": "blah NRK retter",
        "Foo. Bar.Baz NRK retter": "Bar.Baz NRK retter",
        "Bar.Baz NRK retter": "Baz NRK retter",
        "Først. Så en retting, og en retting til": "Så en retting, og en retting til",
        "": "",
    }
    assert one(spark, fn.trim_to_correction, list(cases)) == list(cases.values())
    assert one(spark, fn.trim_to_correction, [None]) == [None]


def test_position(spark):
    assert one(spark, fn.trigger_position, ["x retting.", "retting", "nrk retter retting", "ingen", "feilretting retting"]) == [3, 1, 1, 0, 13]


def test_quality(spark):
    cases = {"feil.": True, "kl 12.30": True, "i 2024": True, "feil": False, "   ": False, "«x»": True, "slutt.  ": True}
    assert one(spark, fn.looks_complete, list(cases)) == list(cases.values())
    long = "i en tidligere publisert versjon"
    cases = {"x" * 49 + "nrk retter": True, "x" * 50 + "nrk retter": False, "x" * 49 + long: False, "x" * 48 + long: True, "x " + "retting": True}
    assert one(spark, fn.starts_with_trigger, list(cases)) == list(cases.values())
    assert one(spark, fn.needs_refetch, [None, "", "nrk retter feil.", "nrk retter feil", "feil."]) == [True, True, False, True, True]


@pytest.mark.parametrize(
    ("new", "old", "better"),
    [("", "x", False), (None, "x", False), ("nrk retter", "x", True), ("x.", "nrk retter", True), ("x", "x", False), ("nrk retter.", "nrk retter.", False), ("nrk retter", None, True)],
)
def test_better(spark, new, old, better):
    assert values(spark, [(new, old)], "n string, o string", fn.is_better(F.col("n"), F.col("o"))) == [(better,)]


@pytest.mark.parametrize(
    ("start", "end", "hours"),
    [
        ("2024-01-01T00:00:00Z", "2024-01-02", 36.0),
        ("2024-01-01T00:00:00+01:00", "2024-01-01T00:30:00+01:00", 0.5),
        ("2024-01-02T00:00:00Z", "2024-01-01", None),
        ("2018-01-01T00:00:00Z", "2024-01-01", None),
        ("2024-01-01T00:00:00", "2024-01-01T01:00:00Z", 1.0),
        ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", 0.0),
        ("2019-01-02T00:00:00Z", "2024-01-01T00:00:00Z", 43800.0),
        ("", "2024-01-01", None),
        (None, "2024-01-01", None),
        ("2024-01-01T00:00:00Z", "garbage", None),
        ("2024", "2024-01-01", None),
    ],
)
def test_hours(spark, start, end, hours):
    assert values(spark, [(start, end)], "a string, b string", fn.hours_between(F.col("a"), F.col("b"))) == [(hours,)]


def test_section(spark):
    base = "https://www.nrk.no/"
    cases = {base + "sport/x-1": "sport", base + "foo?x=1": "foo", base: "ukjent", base + "foo?u=a/b": "foo?u=a", "https://example.com/a": "https:"}
    assert one(spark, fn.url_section, list(cases)) == list(cases.values())


def test_labels(spark):
    rows = [(None,), (0.5,), (1.2,), (23.6,), (24.0,), (36.0,)]
    assert [v for (v,) in values(spark, rows, "h double", fn.duration_label(F.col("h")))] == [None, "Under 1 time", "1 time", "24 timer", "1 dag", "2 dager"]
    assert one(spark, fn.long_date, ["2024-05-17", "2024-05-17T10:00:00Z", "snart", None]) == ["17. mai 2024", "17. mai 2024", "snart", ""]
    assert one(spark, lambda c: label_of(c, TYPE_LABELS, fallback=True), ["wrong_name", "new"]) == ["Feil navn", "new"]
    assert one(spark, lambda c: label_of(c, TYPE_LABELS, fallback=False), ["new"]) == [None]


def test_markup_and_json(spark):
    assert one(spark, fn.html_escape, ['<a href="x">&</a>', None]) == ["&lt;a href=&quot;x&quot;&gt;&amp;&lt;/a&gt;", ""]
    assert one(spark, fn.without_fence, ['```json\n{"a": 1}\n```', " x ", "```\n{}"]) == ['{"a": 1}', "x", "{}"]
    assert one(spark, lambda c: fn.json_object(c).isNotNull(), ["{}", '{"a":1}', "[1]", "3", "{x", None]) == [True, True, False, False, False, False]
    assert one(spark, fn.without_suffixes, ["A – NRK", "A - NRK – NRK", "A"]) == ["A", "A", "A"]
    assert one(spark, fn.quoted_query, ["endringane vart gjort", "rettelse:"]) == ["%22endringane%20vart%20gjort%22", "%22rettelse%3A%22"]


def test_blank(spark):
    rows = [("", "b"), (None, "b"), ("a", "b"), ("", "")]
    assert [v for (v,) in values(spark, rows, "a string, b string", fn.blank_coalesce(F.col("a"), F.col("b")))] == ["b", "b", "a", None]

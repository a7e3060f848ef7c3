import hashlib

from errata.llm import warc
from errata.llm.common import scratch_path


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], "page_id long, url string, html string, value int, record_id string")


BIG = "<p>é東" + "x" * 2000 + "\r\n\r\nWARC/1.1\r\n</p>"
ROWS = [
    (1, "http://a/1", BIG), (7, "http://a/7", BIG), (3, None, BIG), (2, "http://b\r\nX: y", "small"), (4, "http://c", "small"), (5, "http://d", None),
    (6, "http://e", ""), (8, "http://f", "y" * 999), (9, "http://g", "y" * 999), (10, "http://h", "z" * 1000), (11, "http://i", "z" * 1000), (None, "http://j", "z" * 1000), (12, "http://k", "q" * 1500),
]


def run(spark, rows, **options):
    source, target = scratch_path(spark, "w"), scratch_path(spark, "v")
    warc.write_archive(pages(spark, rows), source, **options)
    warc.deduplicate_archive(spark, source, target, **options)
    return source, target


def test_round_trip(spark):
    source, _ = run(spark, ROWS)
    got = sorted((str(r.page_id), r.payload, r.payload_digest, r.payload_bytes) for r in warc.read_records(spark, source, with_payload=True).collect())
    want = [(str(i) if i is not None else "None", h or "", hashlib.sha1((h or "").encode()).hexdigest(), len((h or "").encode())) for i, _, h in ROWS]
    assert got == sorted(want)


def test_resolution(spark):
    _, target = run(spark, ROWS, records_per_file=3)
    rows = {r.page_id: r for r in warc.read_records(spark, target, with_payload=True).collect()}
    kinds = {k: (r.record_type, r.refers_to_page) for k, r in rows.items()}
    response = ("response", None)
    assert kinds == {"1": ("revisit", "7"), "3": ("revisit", "7"), "7": response, "2": response, "4": response, "5": response, "6": response, "8": response, "9": response, "10": ("revisit", "11"), "11": response, None: ("revisit", "11"), "12": response}
    assert rows["1"].payload == "" and rows["1"].payload_bytes == len(BIG.encode()) and rows["7"].payload == BIG
    assert rows["1"].refers_to == rows["7"].record_id
    assert rows["2"].url == "http://b  X: y"
    assert rows["3"].url is None


def test_repeated_rows_and_empty(spark):
    _, target = run(spark, [(1, "u", BIG), (1, "u", BIG)])
    assert sorted(r.record_type for r in warc.read_records(spark, target).collect()) == ["response", "revisit"]
    _, target = run(spark, [])
    assert warc.read_records(spark, target).count() == 0


def test_members(monkeypatch):
    import gzip

    import pytest

    assert list(warc._unpacked(b"")) == []
    two = gzip.compress(b"a" * 100) + gzip.compress(b"b" * 5000)
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(warc, "UNPACKED", size)
        pieces = list(warc._unpacked(two))
        assert b"".join(pieces) == b"a" * 100 + b"b" * 5000 and max(map(len, pieces)) <= max(size, 64)
    with pytest.raises(EOFError):
        list(warc._unpacked(two[:-9]))


def test_long_payloads_and_odd_ids(spark, monkeypatch):
    """Few records to a file where they are long, batches by bytes, and ids that are no numbers."""
    monkeypatch.setattr(warc, "BATCH_BYTES", 1000)
    long = "é" * 3_000_000
    rows = [(i, "u", long if i % 2 else f"x{i}") for i in range(6)]
    assert warc.per_file(6_000_000) == 44 and warc.per_file(None) == warc.RECORDS_PER_FILE and warc.per_file(1 << 40) == 1
    source, target = run(spark, rows)
    got = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.read_records(spark, target).collect()}
    assert got["1"] == (6_000_000, "revisit") and got["5"] == (6_000_000, "response") and len(got) == 6
    assert {r.page_id: len(r.payload) for r in warc.read_records(spark, source, with_payload=True).collect()}["3"] == 3_000_000
    named = spark.createDataFrame([("a", "u", "y" * 2000), ("b", "u", "y" * 2000), ("7", "u", "z" * 2000), ("c", "u", "z" * 2000)], "page_id string, url string, html string")
    source, target = scratch_path(spark, "w"), scratch_path(spark, "v")
    warc.write_archive(named, source)
    warc.deduplicate_archive(spark, source, target)
    assert {r.page_id: r.refers_to_page for r in warc.read_records(spark, target).collect()} == {"a": "b", "b": None, "7": None, "c": "7"}

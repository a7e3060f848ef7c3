"""WARC archives and revisit resolution.

write_archive() writes one response record per row; read_records() reads archives back; resolve()
decides by shuffled headers which records repeat the payload of another; write_resolved() writes
archives in which these are revisit records with headers of their own and no payload.

Spark's own text writer and binary reader do the file access, so that archives can lie in any store
that Spark reaches. A record ends with the two line ends that the format asks for, which is the
writer's line separator. Files are compressed as a whole and hold `records_per_file` at most.

Scale: payloads are moved once, by the unique record id; a digest that very many records share only
moves headers, which are aggregated before their shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from errata.llm.common import mapped, scratch_path, table, written

LEAST_BYTES = 1000
#: A file has at most so many records, and fewer if the longest payload times them is over so many bytes.
RECORDS_PER_FILE, FILE_BYTES = 500, 256 << 20
#: Bytes that are unpacked at once, and of payloads that a batch of records holds, about.
UNPACKED, BATCH_BYTES = 1 << 20, 32 << 20
DATE = "1970-01-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = "record_id string, page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, refers_to_page string"
#: gzip, however many members a file has.
GZIP = 31


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null. Control characters become spaces."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1f\x7f]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(END)), F.lit(""))


def _record(kind: Column, payload: Column, size: Column, original: Column | None = None) -> Column:
    """A record's text without its end. Its block is an HTTP head and, in responses, the payload.

    Uses the columns record_id, page_id, url and payload_digest.
    """
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size.cast("string"), F.lit(END + END))
    revisit = kind == "revisit"
    lines = [
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Page-ID", F.col("page_id")),
        _line("WARC-Payload-Length", size),
    ]
    if original is not None:
        lines += [
            _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:uuid:"), original["record_id"], F.lit(">")))),
            _line("WARC-Refers-To-Target-URI", F.when(revisit, original["url"])),
            _line("WARC-Refers-To-Page-ID", F.when(revisit, original["page_id"])),
        ]
    body = F.when(revisit, F.lit("")).otherwise(payload)
    length = F.octet_length(head) + F.octet_length(body)
    lines += [_line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", length)]
    return F.concat(*lines, F.lit(END), head, body).alias("value")


def per_file(longest: int | None, most: int = RECORDS_PER_FILE) -> int:
    """Records of a file, given the bytes of the longest payload."""
    return max(1, min(most, FILE_BYTES // max(1, longest or 1)))


def _write(records: DataFrame, path: str, records_per_file: int) -> None:
    # Archives are written twice and read thrice here: packing them fast saves more than packing them tight.
    records.write.option("lineSep", END + END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path)


def write_archive(pages: DataFrame, path: str, *, records_per_file: int = RECORDS_PER_FILE) -> None:
    """A response record for each row of pages (page_id, url, html); null html is an empty payload.

    Repeated rows get records of their own. A null page_id or url leaves its header out.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    records_per_file = per_file(pages.agg(F.max(F.octet_length("html"))).first()[0], records_per_file)
    number = F.sha1(F.concat_ws(":", F.monotonically_increasing_id(), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    parts = [F.substring(number, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    rows = pages.select("page_id", "url", payload.alias("html"), F.concat_ws("-", *parts).alias("record_id"), F.sha1(payload.cast("binary")).alias("payload_digest"))
    _write(rows.select(_record(F.lit("response"), F.col("html"), F.octet_length("html"))), path, records_per_file)


def _unpacked(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, in pieces of at most UNPACKED bytes."""
    member, begun = zlib.decompressobj(GZIP), False
    for at in range(0, len(data), UNPACKED):
        rest = data[at : at + UNPACKED]
        while rest:
            begun = True
            if piece := member.decompress(rest, UNPACKED):
                yield piece
            rest = member.unconsumed_tail
            if member.eof:
                rest, begun = member.unused_data, False
                member = zlib.decompressobj(GZIP)
    if begun:
        if piece := member.flush():
            yield piece
        if not member.eof:
            raise EOFError("the archive ends within a member")


def _parse(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, by the lengths that the records state. Of the archive the last
    pieces are held, back to the start of the record."""
    held, at = b"", 0
    while True:
        stop = held.find(b"\r\n\r\n", at)
        end = -1
        if stop >= 0:
            first, *lines = held[at:stop].decode().split(END)
            if not first.startswith("WARC/"):
                raise ValueError("no record begins where the one before ends")
            headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
            end = stop + 4 + int(headers["content-length"])
        if stop < 0 or len(held) < end + 4:
            more, wanted = [held[at:]], max(1, end + 4 - len(held))
            while wanted > 0 and (piece := next(pieces, None)) is not None:
                more.append(piece)
                wanted -= len(piece)
            if len(more) == 1:
                if more[0]:
                    raise ValueError("the archive ends within a record")
                return
            held, at = b"".join(more), 0
            continue
        yield headers, held[stop + 4 : end]
        at = end + 4


def read_records(spark: SparkSession, path: str, *, with_payload: bool = False) -> DataFrame:
    """The records of an archive: the columns of HEADERS, and the payload as a string if asked for.

    An archive without files gives no rows. A revisit's length and digest are those of its payload.
    Missing ids and addresses are null; an empty payload is the empty string. Of a file, the packed
    bytes, a record and a batch of payloads are held at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * (4 if with_payload else 3)
        names = [x.split()[0] for x in HEADERS.split(", ")] + ["payload"] * with_payload

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in _parse(_unpacked(content.as_py())):
                    get = headers.get
                    row = [get("warc-record-id", "")[10:-1], get("warc-page-id"), get("warc-target-uri"), get("warc-type"), int(headers["warc-payload-length"]), headers["warc-payload-digest"].removeprefix("sha1:")]
                    row += [(get("warc-refers-to") or "")[10:-1] or None, get("warc-refers-to-page-id")]
                    if with_payload:
                        row.append(block.split(b"\r\n\r\n", 1)[1].decode())
                    rows.append(row)
                    size += len(block) if with_payload else 0
                    if size > BATCH_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                yield out(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return mapped(files.select("content"), read, HEADERS + ", payload string" * with_payload)


def resolve(headers: DataFrame, *, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Of each record that repeats a payload of at least least_bytes: record_id and `original`.

    The original of a digest is its record of the largest page_id, of several such the one with the
    largest record_id. Ids that are no whole numbers come before those that are, in the order of
    texts; a null one counts as smallest.
    """
    large = headers.filter(F.col("payload_bytes") >= least_bytes)
    order = F.struct(F.expr("try_cast(page_id AS bigint)").alias("number"), F.when(F.expr("try_cast(page_id AS bigint)").isNull(), F.col("page_id")).alias("name"), "record_id", "page_id", "url")
    originals = large.groupBy("payload_digest", "payload_bytes").agg(F.max(order).alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = large.select("record_id", "payload_digest", "payload_bytes").join(originals, ["payload_digest", "payload_bytes"])
    return joined.filter("record_id != original.record_id").select(F.col("record_id").alias("revisit_id"), "original")


def write_resolved(records: DataFrame, revisits: DataFrame, path: str, *, records_per_file: int = RECORDS_PER_FILE) -> None:
    """The records, those that resolve() names as revisits without payload and with fresh headers."""
    joined = records.join(revisits, F.col("record_id") == F.col("revisit_id"), "left")
    kind = F.when(F.col("revisit_id").isNotNull(), "revisit").otherwise("response")
    _write(joined.select(_record(kind, F.col("payload"), F.col("payload_bytes"), F.col("original"))), path, records_per_file)


def deduplicate_archive(spark: SparkSession, source: str, target: str, *, least_bytes: int = LEAST_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Read the archive at source, resolve its revisits and write the result to target."""
    headers = written(read_records(spark, source), "headers")
    revisits = written(resolve(headers, least_bytes=least_bytes), "revisits")
    records_per_file = per_file(headers.agg(F.max("payload_bytes")).first()[0], records_per_file)
    write_resolved(read_records(spark, source, with_payload=True), revisits, target, records_per_file=records_per_file)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record, revisits resolved, and the archive read back: its headers."""
    pages = table(spark, sf_dir, "pages")
    source, target = scratch_path(spark, "warc"), scratch_path(spark, "warc-resolved")
    write_archive(pages, source)
    deduplicate_archive(spark, source, target)
    number = pages.schema["page_id"].dataType
    return read_records(spark, target).select(F.col("page_id").cast(number), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").cast(number).alias("refers_to"))


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), o AS (
  SELECT digest, n, max(page_id) AS original FROM p WHERE n >= 1000 GROUP BY digest, n
)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN o.original <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN o.original <> p.page_id THEN o.original END AS refers_to
FROM p LEFT JOIN o ON p.digest = o.digest AND p.n = o.n
"""

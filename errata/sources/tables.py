"""Stored tables: JSON arrays, sitemaps, checkpoints, dead letters; and their sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errata.schema import CHECKPOINT_DDL, DEAD_LETTER_DDL, RAW_DDL, SITEMAP_DDL

#: The file of a replaced table that names its current version.
POINTER = "_CURRENT"
#: What stands between two records of an array that is indented by two, and nowhere else in it: a JSON
#: string has no line breaks, and what is nested is indented further.
BETWEEN = "\n  },\n  {\n"
OPENING, CLOSING = "[\n", "\n]\n"
#: A worker hands on what it has written once it holds so many characters.
PIECE = 1 << 20


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def json_table(spark: SparkSession, path: str, schema: str = RAW_DDL, *, required: bool = False) -> DataFrame:
    """A JSON array of records. A missing file is an empty table, unless it is required. Files that are
    indented as write_array() does are read by ranges of bytes, others each by one task."""
    if not required and not exists(spark, path):
        return spark.createDataFrame([], schema)
    if not _indented(spark, path):
        return spark.read.schema(schema).option("multiLine", True).json(path)
    text = F.col("value")
    opened = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("[{"), text))
    closed = F.when(text.rlike(r"\n\]\s*\z|^\[\]\s*\z"), opened).otherwise(F.concat(opened, F.lit("}]")))
    record = T.StructType.fromDDL(schema)
    unreadable = F.array(F.lit(None).cast(record))  # a row of nulls, as Spark's reader has it
    records = F.coalesce(F.from_json(closed, T.ArrayType(record)), unreadable)
    return spark.read.option("lineSep", BETWEEN).text(path).select(F.inline(records))


def _indented(spark: SparkSession, path: str) -> bool:
    """Whether all files at path begin as arrays of records that are indented by two, or are empty."""
    fs, jpath = _files(spark, path)
    place = jpath(path)
    if not fs.exists(place):  # a pattern, or nothing
        return False
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if name[0] in "_.":
            continue
        if status.isDirectory():
            return False
        data = fs.open(status.getPath())
        head = bytes(b for _ in range(6) if (b := data.read()) >= 0).decode("latin-1")
        data.close()
        if head not in ("", "[]", "[]\n", "[\n  {\n"):
            return False
    return True


def stored_table(spark: SparkSession, path: str, schema: str = RAW_DDL) -> DataFrame:
    """The same, stored as Parquet: the current version, if the table is one that replace() writes."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_version(spark, path) or path)


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return json_table(spark, path, DEAD_LETTER_DDL)


def completed(spark: SparkSession, path: str) -> DataFrame:
    """The sitemaps that a checkpoint names: loc."""
    return json_table(spark, path, CHECKPOINT_DDL).select(F.explode("completed_sitemaps").alias("loc")).distinct()


def sitemap_index(spark: SparkSession, path: str) -> DataFrame:
    return _sitemap(spark, path, "sitemap")


def sitemap_urls(spark: SparkSession, path: str, *, partitions: str = "") -> DataFrame:
    """loc and lastmod of all sitemaps below path, and the columns that its folders name."""
    return _sitemap(spark, path, "url", partitions)


def _sitemap(spark: SparkSession, path: str, row: str, partitions: str = "") -> DataFrame:
    schema = f"{SITEMAP_DDL}, {partitions}" if partitions else SITEMAP_DDL
    return spark.read.format("xml").schema(schema).option("rowTag", row).load(path)


def pages_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and Hadoop's Path type."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    return jpath(path).getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there in one step, over what was there."""
    fs, jpath = _files(spark, path)
    side = jpath(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(side, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    over = spark._sc._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(side, jpath(path), over)


def _version(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version of a replaced table, or null if there is none."""
    fs, jpath = _files(spark, path)
    pointer = jpath(f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return None
    data = fs.open(pointer)
    name = spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    data.close()
    return f"{path}/{name}"


def replace(df: DataFrame, path: str) -> None:
    """Overwrite a table that df may itself be read from.

    The rows go to a new folder of the table; then a pointer file is moved over the old one, in one
    step. A reader finds the old version or the new one, a crash in between leaves the old. The
    version before stays for those who read it still; older ones are deleted.
    """
    spark = df.sparkSession
    before = _version(spark, path)
    name = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    _put(spark, f"{path}/{POINTER}", name)
    fs, jpath = _files(spark, path)
    keep = {name, before.rsplit("/", 1)[1] if before else name}
    for status in fs.listStatus(jpath(path)):
        own = status.getPath().getName()
        if own.startswith("version-") and own not in keep:
            fs.delete(status.getPath(), True)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON record a line, in the order of df; the edge format for other programs."""
    df.write.mode("overwrite").json(path)


def write_array(df: DataFrame, path: str) -> None:
    """df as JSON arrays, indented, with its null fields: an array for each part of df, in one file.
    A part without rows is an empty array, no parts an empty file. json_table() reads them back."""

    def indented(record: pa.StringScalar) -> str:
        return "  " + json.dumps(json.loads(record.as_py()), indent=2, ensure_ascii=False).replace("\n", "\n  ")

    def as_lines(values: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (indented(record) for batch in batches for record in batch.column("record"))
        if (last := next(texts, None)) is None:
            yield as_lines(["[]"])
            return
        last, held, size = OPENING + last, [], 0
        for text in texts:
            held.append(last + ",")
            size += len(last)
            last = text
            if size >= PIECE:
                yield as_lines(held)
                held, size = [], 0
        yield as_lines([*held, last, "]"])

    records = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))
    records.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def export_dated(df: DataFrame, folder: str, day: date, name: str = "rettelser") -> str:
    """The full set as one JSON array in a folder that the date names; returns its path. One file is
    the feature here: it is what a person downloads. Its parts are written side by side; then the
    driver strings their bytes together, and deletes each part once it is in."""
    path = f"{folder}/{name}-{day.isoformat()}.json"
    side = f"{folder}/_{name}-{uuid.uuid4().hex}"
    spark = df.sparkSession
    fs, jpath = _files(spark, path)
    try:
        write_array(df, f"{side}/parts")
        _join_arrays(spark, f"{side}/parts", f"{side}/whole/part-00000.json")
        fs.delete(jpath(path), True)
        if not fs.rename(jpath(f"{side}/whole"), jpath(path)):
            raise OSError(f"cannot move the export to {path}")
    finally:
        fs.delete(jpath(side), True)
    return path


def _join_arrays(spark: SparkSession, parts: str, target: str) -> None:
    """The arrays that write_array() has left in a folder, as one in the order of the parts."""
    fs, jpath = _files(spark, target)
    files = [s for s in fs.listStatus(jpath(parts)) if s.getPath().getName().startswith("part-")]
    full = sorted((s for s in files if s.getLen() > len("[]\n")), key=lambda s: int(s.getPath().getName().split("-")[1]))
    between = OPENING
    buffer = spark._sc._gateway.new_array(spark._jvm.byte, 1 << 20)
    out = fs.create(jpath(target), True)
    for status in full:
        out.write(bytearray(between.encode()))
        data = fs.open(status.getPath())
        inner = status.getLen() - len(OPENING) - len(CLOSING)
        copied = spark._jvm.org.apache.commons.io.IOUtils.copyLarge(data, out, len(OPENING), inner, buffer)
        data.close()
        if copied != inner:
            raise OSError(f"{status.getPath()} ends after {copied} of {inner} bytes")
        fs.delete(status.getPath(), False)
        between = ",\n"
    out.write(bytearray((CLOSING if full else "[]\n").encode()))
    out.close()


def counting(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """df, and the counters of a run over it: `rows` and each condition's count. They can be read once
    an action on df has ended, and cost no other pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()]), seen

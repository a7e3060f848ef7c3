"""Incremental collection and counts on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from errata.functions.lexicon import NORWEGIAN, Lexicon
from errata.operators.collect import first_seen, records, unknown
from errata.operators.extract import detect
from errata.schema import RAW_DDL
from errata.sources.html import parsed
from errata.sources.tables import exists


def page_stream(spark: SparkSession, folder: str, schema: str = "page_id long, url string, html string", files_at_once: int = 1) -> DataFrame:
    """Parquet files of pages as they arrive; a file is the unit of progress."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def deal(pages: DataFrame, folder: str, batches: int) -> int:
    """Write pages as Parquet files for a stream of so many batches, each of as many files as pages has
    parts, so that a file stays small. Returns the files of a batch, for page_stream()."""
    parts = max(1, pages.rdd.getNumPartitions())
    pages.repartition(batches * parts).write.parquet(folder)
    return parts


def collect_stream(pages: DataFrame, target: str, checkpoint: str, *, source: str, ingested: datetime, lexicon: Lexicon = NORWEGIAN) -> StreamingQuery:
    """Append the corrections of new pages to the Parquet table at target, until all that is there is
    read. A batch that is repeated after a failure adds nothing twice: its urls are then known. Of the
    table, a batch reads the urls alone."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        known = spark.read.schema(RAW_DDL).parquet(target) if exists(spark, target) else spark.createDataFrame([], RAW_DDL)
        fresh = unknown(first_seen(batch.select("url", "html"), "url"), known)
        rows = records(detect(parsed(fresh), lexicon), source, ingested)
        full = spark.createDataFrame([], RAW_DDL).unionByName(rows, allowMissingColumns=True)
        full.write.mode("append").parquet(target)

    return pages.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(events: DataFrame, column: str = "ts", delay: str = "1 day") -> DataFrame:
    """day, n in event time, with a watermark; works on streams and tables."""
    stamped = events.withColumn("errata_ts", F.col(column).cast("timestamp"))
    if stamped.isStreaming:
        stamped = stamped.withWatermark("errata_ts", delay)
    windows = stamped.groupBy(F.window("errata_ts", "1 day")).agg(F.count("*").alias("n"))
    return windows.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n")


def within(query: StreamingQuery, seconds: float) -> bool:
    """Let a stream run for so long, and stop it then: whether it ended by itself. What it has done is
    kept, and the next run goes on from there."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)


def refreshed(view: DataFrame, refresh: Callable[[DataFrame, int], None], checkpoint: str, every: str = "30 minutes") -> StreamingQuery:
    """Call refresh on what is new, at a fixed interval."""
    return view.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()

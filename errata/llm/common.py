"""What the training-data operators share: tables, the shared working folder, row keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """df.mapInArrow, with batches of at most BATCH_ROWS rows: texts can be long, and a worker and its
    executor hold a batch at a time. A smaller setting of the session stays."""
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_SETTING, "10000")) not in range(1, BATCH_ROWS + 1):
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one named in spark.checkpoint.dir.

    Only a session without that setting (a local test) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="errata-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/errata/{name}-{uuid.uuid4().hex}"


#: The folders that written() has made within each scratch() that is open.
_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What written() makes within is deleted at the end, but for what is to be kept."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        _delete(spark, made)


def written(df: DataFrame, name: str, compression: str = "snappy", *, keep: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    Cuts the lineage and survives lost executors: later stages read files, not shuffle blocks.
    """
    path = scratch_path(df.sparkSession, name)
    if _OPEN and not keep:
        _OPEN[-1].append(path)
    # Once it is written, the shuffle files that it was made from are of no use.
    before = df.sparkSession.conf.get(CLEAN_UP, "false")
    df.sparkSession.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        df.sparkSession.conf.set(CLEAN_UP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the folders of frames made by written(), once nothing reads them any more."""
    for df in frames:
        _delete(df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()})


def _delete(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo modulus (null id: crc32 of the empty text, 0)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus

"""Cutting the lineage of iterative plans through the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local-mode session may go without it."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not conf.get("spark.master", "local").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _MADE:
        _MADE[app] = tempfile.mkdtemp(prefix="lexipress-cut-")
        atexit.register(shutil.rmtree, _MADE[app], ignore_errors=True)
    return _MADE[app]


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with contextlib.suppress(Exception):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(hadoop)  # what does not exist is not deleted later
        files.deleteOnExit(hadoop)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df``, computed once, written to the shared folder and read from there from now on."""
    path = folder(df.sparkSession, "cut")
    df.write.mode("append").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.cut_path = path
    return table


def drop(table: DataFrame) -> None:
    """Delete what ``cut`` has written and nothing reads any more."""
    spark = table.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.cut_path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a table of fewer splits than cores is dealt out anew before work that costs much a row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded_batches(spark: SparkSession, rows: int = 256, size: int = 16 << 20) -> None:
    """Bound the Arrow batches that Python gets, so that texts and sets of a batch fit its memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share, for files of a format of our own."""
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)

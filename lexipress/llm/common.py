"""Shared plumbing: table reads, the shared scratch folder, file systems."""

from __future__ import annotations

import atexit
import contextlib
import sys
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Upper bounds of one Arrow batch handed to Python; long texts arrive a few rows at a time.
ARROW_ROWS = 1000
ARROW_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches so that a Python worker holds a few MB of text at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


@contextlib.contextmanager
def rows_in_a_batch(spark: SparkSession, rows: int):
    """Within, queries that are run hand Python at most so many rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local-mode session may go without it; a temporary folder is then
    used, because driver and executors are one process.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not conf.get("spark.master", "local").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = _LOCAL.setdefault(spark.sparkContext.applicationId, "")
    if not made:
        made = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="lexipress-")
        spark.sparkContext.setCheckpointDir(made)
        atexit.register(_remove, made)
    return made


_LOCAL: dict[str, str] = {}


def _remove(uri: str) -> None:
    with contextlib.suppress(Exception):
        fs, path = open_fs(uri)
        fs.delete_dir(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared root; removed when the driver ends."""
    uri = f"{shared_root(spark)}/lexipress/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, uri)
    return uri


def drop_scratch(uri: str) -> None:
    """Free a scratch folder whose contents no later stage reads."""
    _remove(uri)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder; works on the driver and on executors."""
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, Spark deletes a query's shuffle files as soon as it has ended.

    For queries whose rows are written or collected once; without it the files stay
    until the driver's garbage is collected.
    """
    was = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, was)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Scratch folders to drop when each open ``passing`` block ends.
_PASSING: list[list[str]] = []


@contextlib.contextmanager
def passing():
    """Tables that ``materialise`` writes within are dropped at the end, but those that stay."""
    _PASSING.append([])
    try:
        yield
    finally:
        for uri in _PASSING.pop():
            drop_scratch(uri)


def materialise(df: DataFrame, name: str, codec: str = "snappy", stays: bool = False) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back.

    Within ``passing`` the table lives until the end of the block; one that ``stays``
    lives as long as the next outer block, or the driver.
    """
    spark = df.sparkSession
    uri = scratch(spark, name)
    for held in _PASSING[-2:-1] if stays else _PASSING[-1:]:
        held.append(uri)
    with shuffles_dropped(spark):
        df.write.option("compression", codec).parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def leave_memory() -> None:
    """Forget the chunks that a tokenising stage left in this Python worker; stages that need memory call it first."""
    if tokens := sys.modules.get(f"{__package__}.tokens"):
        tokens.forget()


def free_names(df: DataFrame, n: int) -> list[str]:
    """Column names that ``df`` does not have, whatever their case."""
    taken = {c.lower() for c in df.columns}
    return [name for name in (f"_lexi_{k}" for k in range(len(taken) + n)) if name not in taken][:n]


def text_values(column: pa.Array) -> list[str]:
    """Python strings of a column; a null text counts as empty."""
    return [x if x is not None else "" for x in column.to_pylist()]


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

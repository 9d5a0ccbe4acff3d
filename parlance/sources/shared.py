"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of a row or two a range is broadcast up to so many ranges; a megabyte or so.
MOST_RANGES = 20_000
_tables: list[tuple[SparkSession, str]] = []


def is_local(spark: SparkSession) -> bool:
    """Whether all executors are threads of this machine."""
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a temporary one that ends with the process if the
    session runs on this machine alone, as in tests; on a cluster an error, since executors share no such folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="parlance-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed as those of written() are."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _tables.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, computed once, written as Parquet to the shared folder and read from there.

    Cuts the lineage and fixes results that depend on sampled range bounds: whatever reads the table, a
    retry after a lost executor included, sees the same rows. The table is there until free(), the end of the
    scratch() it was written in, or the end of the process.
    """
    spark = df.sparkSession
    path = place(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(since: int = 0) -> None:
    """Removes the tables written so far; what was made of them can't be read any more."""
    while len(_tables) > since:
        spark, path = _tables.pop()
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has ended; nothing left to do
            pass


@contextmanager
def scratch() -> Iterator[None]:
    """Tables written within are removed at its end, so that a driver that lives long doesn't fill the folder; use
    results within, or write them elsewhere."""
    since = len(_tables)
    try:
        yield
    finally:
        free(since)


atexit.register(free)


def width(spark: SparkSession) -> int:
    """Partitions of an explicit range shuffle: the session's spark.sql.shuffle.partitions, sized by whoever runs the job."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_range(table: DataFrame) -> DataFrame:
    """A table of a few numbers and keys for each range, two rows at most, to be joined to the rows of the ranges:
    broadcast while there are few ranges, else left to Spark."""
    return F.broadcast(table) if width(table.sparkSession) <= MOST_RANGES else table

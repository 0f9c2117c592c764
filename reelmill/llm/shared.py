"""Tables that several steps read, and small helpers for columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmill.session import fresh_path


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def frozen(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: they are computed once and survive lost executors. The shuffle files
    that made them are deleted."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_frozen(df: DataFrame) -> None:
    """Delete the files of a frozen table that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows; from now on the session hands Python 4 MB of them at a time, so that many long texts in a row
    take no more memory than short ones."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df


def give_back() -> None:
    """Return memory that this Python process has freed to the system, Arrow's pool included. Workers serve one stage after
    the other, and what an earlier one needed would else count against the executor's limit in a later one."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def only(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The named columns, cast; whatever else the table holds stays out of the operator's way."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()])


def schema(text: str) -> T.StructType:
    """A schema from its DDL text."""
    return T.StructType.fromDDL(text)


def key_hash(col: Column) -> Column:
    """A hash of a key in 0 .. 2**60 - 1 that SQL engines can repeat: 15 hex digits of the MD5 of its text.
    A missing key hashes like the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def hash_sample(rows: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """About ``size`` rows, never more than twice as many: those whose key hashes below a threshold.

    The threshold comes from the number of rows, so no task sees more than its share of the sample.
    """
    share = size / max(rows.count(), 1)
    chosen = rows.where(key_hash(F.col(key)) < int(min(share, 1.0) * 2 ** 60))
    return chosen.limit(2 * size)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], schema(ddl))


def union(frames: Iterable[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first

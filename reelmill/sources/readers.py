"""Reading delimited dumps and parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelmill.functions.columns import NULL_MARKER


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "\t",
    null: str = NULL_MARKER,
    spread: int | None = None,
) -> DataFrame:
    """A dump with a header line, every column as its schema says (strings for raw dumps).

    Quotes are ordinary characters: a title may start with one. Empty fields read as NULL. The header
    has to match the schema. A ``.gz`` file is one task, so if any of the files found is one, rows are
    spread out right after the scan, over ``spread`` partitions or at least as many as there are such files.
    """
    rows = (
        spark.read.schema(schema)
        .options(sep=sep, header=True, nullValue=null, quote="", enforceSchema=False)
        .csv(path)
    )
    packed = 0 if spread else sum(name.endswith(".gz") for name in rows.inputFiles())
    if packed:
        spread = max(packed, spark.sparkContext.defaultParallelism)
    return rows.repartition(spread) if spread else rows


def scan_parquet(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """A parquet table; the named columns alone reach the scan."""
    table = spark.read.parquet(path)
    return table.select(*cols) if cols else table


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, copies kept, columns matched by name."""
    return reduce(DataFrame.unionByName, parts)


def read_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Many files of one dataset as one scan."""
    return spark.read.parquet(*paths)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames known to ``spark.sql`` under the given names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)

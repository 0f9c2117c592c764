"""Fingerprints of files and tables, and what changed since the last ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Stands for NULL in a hashed row, so that NULL and an empty text differ.
_NULL_TEXT = "\u0000"
_FIELD_END = "\u0001"

def _lanes(digest: Column) -> list[Column]:
    """The four 32-bit parts of an MD5 as numbers, each summed without overflow."""
    parts = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)") for i in range(4)]
    return [F.coalesce(F.sum(part), F.lit(0).cast("decimal(38,0)")).cast("string") for part in parts]


def _combined(rows: Column, digest: Column) -> Column:
    """A hash of a set of rows that does not depend on their order; copies count."""
    return F.md5(F.concat_ws(":", rows.cast("string"), *_lanes(digest)))


def table_fingerprint(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """``n`` and ``md5_hash`` of a table's content, overall or per group; the row order plays no part.

    Every row is hashed where it is read and hashes are summed before the shuffle.
    """
    fields = [F.coalesce(F.col(name).cast("string"), F.lit(_NULL_TEXT)) for name in cols]
    hashed = df.select(*(by or []), F.md5(F.concat_ws(_FIELD_END, *fields)).alias("_digest"))
    return hashed.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), _combined(F.count("*"), F.col("_digest")).alias("md5_hash")
    )


def source_fingerprint(spark: SparkSession, path: str, dataset: str = "file") -> DataFrame:
    """``dataset_name, file_size_bytes, md5_hash`` of the datasets below a path or glob.

    A dataset is a ``file`` or a ``folder`` (all files in it), named by its path below the scheme, or all files of one
    ``name``, named by it. The hash covers the lines
    between line feeds, whatever their order, and is the same for any cut into files; sizes are summed. Lines are hashed
    where they are read, so a file of any size is no more than its tasks' work. Spark passes over empty files, so they are
    no dataset.
    """
    path_only = F.regexp_replace(F.col("path"), "^[a-z0-9]+:/*", "/")
    names = {"file": path_only, "folder": F.regexp_replace(path_only, "/[^/]*$", ""), "name": F.element_at(F.split("path", "/"), -1)}
    if dataset not in names:
        raise ValueError(f"a dataset is one of {sorted(names)}, not {dataset}")
    name = names[dataset]
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "length")
    sizes = files.groupBy(name.alias("dataset_name")).agg(F.sum("length").alias("file_size_bytes"))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.md5("value").alias("_digest"))
    hashes = lines.groupBy(name.alias("dataset_name")).agg(_combined(F.count("*"), F.col("_digest")).alias("md5_hash"))
    return sizes.join(hashes, "dataset_name")


def latest_entries(log: DataFrame) -> DataFrame:
    """The newest log row of every dataset, as ``dataset_name, previous_hash``."""
    return log.groupBy("dataset_name").agg(F.max_by("md5_hash", "ingestion_date").alias("previous_hash"))


def detect_changes(current: DataFrame, log: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Each expected dataset with ``present`` and ``has_changed``.

    A dataset has changed if it has no earlier hash or another one. A dataset that is expected but not
    there has not changed. Without ``expected`` the current datasets are the expected ones.
    """
    names = (expected if expected is not None else current).select("dataset_name").distinct()
    state = names.join(current, "dataset_name", "left").join(latest_entries(log), "dataset_name", "left")
    present = F.col("md5_hash").isNotNull()
    same = F.col("md5_hash").eqNullSafe(F.col("previous_hash"))
    return state.withColumns({"present": present, "has_changed": present & ~same})

"""Ingestion audit: fingerprint the sources, compare with the log, append to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.session import materialize
from reelmill.sources.fingerprints import detect_changes, source_fingerprint
from reelmill.sources.sinks import append_ingestion_log, read_ingestion_log


def ingestion_audit(current: DataFrame, log_path: str, expected: DataFrame | None = None) -> DataFrame:
    """One row per expected dataset with ``present`` and ``has_changed``; what is present is logged.

    ``current`` has ``dataset_name, file_size_bytes, md5_hash``, one row per source. The result is
    frozen before the log grows, so that reading it again does not compare a run with itself.
    """
    log = read_ingestion_log(current.sparkSession, log_path)
    changes = materialize(detect_changes(current, log, expected))
    entries = changes.filter("present").withColumn("ingestion_date", F.current_timestamp())
    append_ingestion_log(entries, log_path)
    return changes.select("dataset_name", "file_size_bytes", "md5_hash", "present", "has_changed")


def audit_files(
    spark: SparkSession, path: str, log_path: str, expected: list[str] | None = None
) -> DataFrame:
    """The audit of all files below a path or glob. Expected file names that are not there are reported."""
    names = None
    if expected is not None:
        names = spark.createDataFrame([(name,) for name in expected], "dataset_name string")
    return ingestion_audit(source_fingerprint(spark, path, dataset="name"), log_path, names)

"""Table and file sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmill.schemas import EVENT, EVENT_CLUSTER, INGESTION_LOG


# The partition of an event table that tells micro-batches apart.
BATCH = "batch_id"
COMPACTED = -1  # the number of rows that were joined from several batches


def _is_path(target: str) -> bool:
    return "/" in target


def write_row_limited(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Parquet files of at most ``rows_per_file`` rows. Tasks write on their own: no shuffle."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_table_overwrite(df: DataFrame, target: str) -> None:
    """Create or replace a table; a target with a slash is a parquet folder."""
    writer = df.write.mode("overwrite")
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def write_with_children(main: DataFrame, children: dict[str, DataFrame], target: str) -> dict[str, str]:
    """A table and its child tables ``{target}_{suffix}``; gives the names of what was written."""
    targets = {"": target, **{suffix: f"{target}_{suffix}" for suffix in children}}
    for suffix, frame in {"": main, **children}.items():
        write_table_overwrite(frame, targets[suffix])
    return targets


def write_counted(
    df: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str
) -> dict[str, int]:
    """Transform and write, counting rows before and after in the same pass as the write."""
    read, written = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    write_table_overwrite(transform(df.observe(read, rows)).observe(written, rows), target)
    return {"rows_before": read.get["rows"], "rows_after": written.get["rows"]}


def create_event_table(
    spark: SparkSession, path: str, schema: T.StructType = EVENT, ts: str = "timestamp"
) -> None:
    """An empty event table partitioned by day, unless there is one already."""
    empty = spark.createDataFrame([], schema).withColumn("event_date", F.to_date(ts))
    empty.write.mode("ignore").partitionBy("event_date").parquet(path)


def write_event_table(
    df: DataFrame, path: str, ts: str = "timestamp", cluster: list[str] | None = None
) -> None:
    """Append events by day, sorted by the cluster columns inside every file.

    Rows are range-partitioned by day, cluster columns and time, so a day or a user that holds most of
    the rows is written by many tasks, and each file covers a narrow range that a filter can skip.
    """
    order = ["event_date", *(cluster or EVENT_CLUSTER), ts]
    dated = df.withColumn("event_date", F.to_date(ts))
    ranged = dated.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("append").partitionBy("event_date").parquet(path)


def read_event_table(spark: SparkSession, path: str, schema: T.StructType = EVENT) -> DataFrame:
    """The event table with its ``event_date``; works before the first event, too."""
    fields = T.StructType([*schema, T.StructField("event_date", T.DateType())])
    return spark.read.schema(fields).parquet(path).select(*fields.names)


def compact_days(spark: SparkSession, path: str, ts: str = "timestamp", cluster: list[str] | None = None, least: int = 2) -> int:
    """Join the micro-batches of every day that has at least ``least`` of them, and give the number of such days.

    Rows are laid out by day, cluster columns and time, as in ``write_event_table``. The last batch of the table stays as it is,
    because a stream may run it again. Joined days are written beside the table first; once they are complete, a plan is
    stored there and each day is exchanged. A run that ends in between is completed by the next one. Run it while no stream
    writes and nobody reads the days in question.
    """
    _exchange(spark, path)
    parts = spark.read.parquet(path).select("event_date", F.col(BATCH).cast("long").alias(BATCH)).distinct()
    batches: dict = {}
    for day, number in parts.collect():  # folders, not rows
        batches.setdefault(day, set()).add(number)
    last = max((n for numbers in batches.values() for n in numbers), default=COMPACTED)
    joined = {day: sorted(numbers - {last}) for day, numbers in batches.items() if day is not None and len(numbers - {last}) >= least}
    if not joined:
        return 0
    rows = spark.read.parquet(path).where(F.col("event_date").isin(list(joined)) & (F.col(BATCH) != last)).drop(BATCH)
    order = ["event_date", *[c for c in (EVENT_CLUSTER if cluster is None else cluster) if c in rows.columns], ts]
    ranged = rows.withColumn(BATCH, F.lit(COMPACTED)).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy("event_date", BATCH).parquet(f"{path}/{_STAGED}")
    plan = [(f"event_date={day}", f"{BATCH}={number}") for day, numbers in joined.items() for number in numbers]
    plan_rows = spark.createDataFrame(plan, "day string, batch string")
    plan_rows.coalesce(1).write.mode("overwrite").json(f"{path}/{_PLAN}")
    _exchange(spark, path)
    return len(joined)


# Readers skip folders whose names begin like this.
_STAGED, _PLAN = "_compacted", "_compaction_plan"


def _exchange(spark: SparkSession, path: str) -> None:
    """Carry out a stored plan, all of it or what is left of it: joined days take the place of their batches."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path

    def at(*parts: str):
        return hadoop("/".join([path, *parts]))

    files = at().getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(at(_PLAN, "_SUCCESS")):
        old: dict[str, list[str]] = {}
        for row in spark.read.schema("day string, batch string").json(f"{path}/{_PLAN}").collect():
            old.setdefault(row.day, []).append(row.batch)
        for day, numbers in old.items():
            staged = at(_STAGED, day, f"{BATCH}={COMPACTED}")
            if files.exists(staged):  # else this day was exchanged before
                for number in numbers:
                    files.delete(at(day, number), True)
                files.rename(staged, at(day, f"{BATCH}={COMPACTED}"))
    files.delete(at(_PLAN), True)
    files.delete(at(_STAGED), True)


def append_ingestion_log(rows: DataFrame, path: str) -> None:
    """Append to the ingestion log, partitioned by day."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in INGESTION_LOG]
    entries = rows.select(*fields).withColumn("ingestion_day", F.to_date("ingestion_date"))
    entries.write.mode("append").partitionBy("ingestion_day").parquet(path)


def read_ingestion_log(spark: SparkSession, path: str) -> DataFrame:
    """The ingestion log, or an empty one before the first run."""
    create = spark.createDataFrame([], INGESTION_LOG).withColumn("ingestion_day", F.to_date("ingestion_date"))
    create.write.mode("ignore").partitionBy("ingestion_day").parquet(path)
    day = T.StructField("ingestion_day", T.DateType())
    return spark.read.schema(T.StructType([*INGESTION_LOG, day])).parquet(path).drop("ingestion_day")

"""Viewing events: read, parse, check, de-duplicate, append by day.

Reading gives a stream. Parsing and checking work on streams and on static frames alike. Appending runs once for each micro-batch:
the batch is laid out by day and user, its ids are looked up in the table's days around it, and it is written under its
batch number, so that a batch that is run again replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelmill.functions.columns import all_of
from reelmill.schemas import EVENT, EVENT_CLUSTER, EVENT_REQUIRED
from reelmill.sources.sinks import BATCH

_CORRUPT, _MESSAGE, _REASON = "_corrupt_record", "_message", "_reason"


def read_event_stream(
    spark: SparkSession,
    source: str,
    options: dict[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """An unbounded frame of messages: ``kafka`` in production, ``text`` or ``parquet`` files elsewhere."""
    reader = spark.readStream.format(source).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def parse_events(
    messages: DataFrame, schema: T.StructType = EVENT, value: str = "value", id_field: str = "event_id"
) -> tuple[DataFrame, DataFrame]:
    """JSON messages to ``(events, dead letters)``.

    A message is dead if its bytes are no UTF-8, it is no JSON object, a field has the wrong type, or it
    has no id. Unknown fields are left out. Dead letters keep the message and say why.
    """
    checked = _checked(messages, schema, value, id_field)
    good = checked.filter(F.col(_REASON).isNull()).select(*schema.names)
    dead = checked.filter(F.col(_REASON).isNotNull()).select(
        F.col(_MESSAGE).alias("message"), F.col(_REASON).alias("reason")
    )
    return good, dead


def _checked(messages: DataFrame, schema: T.StructType, value: str, id_field: str) -> DataFrame:
    """Each message with its parsed fields and, if it is dead, the reason."""
    widened = T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())])
    message = messages.select(F.col(value).alias(_MESSAGE))
    text = F.col(_MESSAGE).cast("string")
    # A generator is evaluated once per row. As a plain column the parser would be copied into the
    # filter and into every field that is read from its result.
    parsed = F.inline(F.array(F.from_json(text, widened, {"columnNameOfCorruptRecord": _CORRUPT})))
    reason = (
        F.when(F.col(_MESSAGE).isNull(), "no message")
        .when(~F.is_valid_utf8(text), "not UTF-8")
        .when(~F.ltrim(text).startswith("{") | F.col(_CORRUPT).isNotNull(), "malformed")
        .when(F.col(id_field).isNull(), f"no {id_field}")
    )
    return message.select(_MESSAGE, parsed).withColumn(_REASON, reason)


def enforce_required(events: DataFrame, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Events with all required fields, and the others with the names of what is missing."""
    required = required or EVENT_REQUIRED
    complete = all_of([F.col(name).isNotNull() for name in required])
    good = events.filter(complete)
    dead = events.filter(~complete).withColumn("reason", _missing(required))
    return good, dead


def _missing(required: list[str]) -> Column:
    return F.concat(F.lit("missing "), F.concat_ws(",", *[F.when(F.col(name).isNull(), name) for name in required]))


def flatten_event(events: DataFrame) -> DataFrame:
    """Nested fields as flat columns, ``device.type`` as ``device_type``."""
    flat = []
    for column in events.schema:
        if isinstance(column.dataType, T.StructType):
            flat += [F.col(column.name)[f.name].alias(f"{column.name}_{f.name}") for f in column.dataType]
        else:
            flat.append(F.col(column.name))
    return events.select(*flat)


def dedupe_events(events: DataFrame, id_field: str, ts: str) -> DataFrame:
    """Each id once: its earliest event, of several at that time the one with the smallest hash. Events without an id stay. For static frames; streams are
    de-duplicated batch by batch as they are appended (``append_events(unique=...)``)."""
    if events.isStreaming:
        raise ValueError("de-duplicate a stream with append_events(unique=...)")
    own = [F.col(f"`{name}`") for name in events.columns]
    place = Window.partitionBy(id_field).orderBy(F.col(ts).asc_nulls_last(), F.xxhash64(*own))
    # Tasks keep one event of an id before the shuffle, so an id with many copies is no large group.
    named = events.filter(F.col(id_field).isNotNull()).withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")
    return named.unionByName(events.filter(F.col(id_field).isNull()))


def drop_known(events: DataFrame, known: DataFrame, id_field: str, days: int) -> DataFrame:
    """Events (with ``event_date``) whose id is not among the known ones (``id_field``, ``event_date``) within so many days.

    The ids of a batch are few against the known ones, so the known ones are searched for them, and only what is found meets
    the events again.
    """
    asked = events.select(F.col(id_field).alias("_id"), F.col("event_date").alias("_day"))
    near = F.abs(F.date_diff(F.col("event_date"), F.col("_day"))) <= days
    found = known.join(asked, (F.col(id_field) == F.col("_id")) & near, "left_semi").select(F.col(id_field).alias("_id")).distinct()
    return events.join(found, F.col(id_field) == F.col("_id"), "left_anti")


# Rows of a micro-batch that one task lays out and writes.
TASK_ROWS = 1_000_000


def _write_batch(rows: DataFrame, path: str, batch: int, count: int, by: list[str], order: list[str]) -> None:
    """Write a micro-batch of about ``count`` rows under its number, in ranges of ``order``. If it was written before, its rows
    are replaced."""
    laid = rows.withColumn(BATCH, F.lit(batch).cast("long"))
    if order:
        laid = laid.repartitionByRange(-(-count // TASK_ROWS) or 1, *order).sortWithinPartitions(*order)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, BATCH).parquet(path)


def _store(events: DataFrame, path: str, batch: int, count: int, ts: str, cluster: list[str], unique: str | None, days: int) -> None:
    """Write the events of a micro-batch by day, without those whose id the table has."""
    spark = events.sparkSession
    dated = events.withColumn("event_date", F.to_date(ts))
    order = ["event_date", *[c for c in cluster if c in events.columns], ts]
    if not unique:
        _write_batch(dated, path, batch, count, ["event_date"], order)
        return
    around = [row[0] for row in dated.select("event_date").distinct().collect() if row[0] is not None]  # days, not rows
    new = dedupe_events(dated, unique, ts)
    if around and _exists(spark, path):
        kinds = {unique: dated.schema[unique].dataType, "event_date": T.DateType(), BATCH: T.LongType()}
        stored = spark.read.schema(T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])).parquet(path)
        # Days that may hold a copy; the batch's own rows, if it is run again, are no copies.
        wanted = F.array_contains(F.lit(sorted(_with_neighbours(around, days))), F.date_diff("event_date", F.lit("1970-01-01").cast("date")))
        new = drop_known(new, stored.where(wanted & (F.col(BATCH) != batch)), unique, days)
    new = new.persist()  # the ranges and the write read it
    try:
        _write_batch(new, path, batch, count, ["event_date"], order)
    finally:
        new.unpersist()


def _with_neighbours(days: list, reach: int) -> set[int]:
    """Day numbers since 1970 of dates and of the days around them."""
    return {number + k for number in ((d.toordinal() - 719163) for d in days) for k in range(-reach, reach + 1)}


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _each_batch(frame: DataFrame, checkpoint: str, trigger: dict | None, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        frame.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_events(
    events: DataFrame, path: str, checkpoint: str, ts: str = "timestamp", trigger: dict | None = None,
    cluster: list[str] | None = None, unique: str | None = None, days: int = 7,
) -> StreamingQuery:
    """Append to the table by day, each micro-batch in ranges of day, cluster columns and time.

    With ``unique`` an event is left out if the table, or the batch, has its id within ``days`` days of its own day. However late
    an event is, it is looked up in its own days and stored: nothing is dropped for its age, and nothing is kept in memory
    between batches. A batch is written under its number, so running it again after a failure adds nothing twice;
    ``compact_days`` joins the batches of a day.
    """
    order = EVENT_CLUSTER if cluster is None else cluster

    def handle(batch: DataFrame, number: int) -> None:
        rows = batch.persist()  # read once for its size, the ranges and the write; a lost block is read again
        try:
            _store(rows, path, number, rows.count(), ts, order, unique, days)
        finally:
            rows.unpersist()

    return _each_batch(events, checkpoint, trigger, handle)


@dataclass
class IngestPaths:
    """Where an ingest writes, all below one folder that every executor can reach."""

    root: str

    @property
    def events(self) -> str:
        return f"{self.root}/events"

    @property
    def dead(self) -> str:
        return f"{self.root}/dead_letters"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def event_ingest(
    messages: DataFrame,
    paths: IngestPaths,
    schema: T.StructType = EVENT,
    required: list[str] | None = None,
    ts: str = "timestamp",
    id_field: str = "event_id",
    dedupe_days: int | None = None,
    trigger: dict | None = None,
    cluster: list[str] | None = None,
) -> list[StreamingQuery]:
    """Messages to the event table and a dead-letter folder, as one streaming query that reads and parses each message once.

    ``dedupe_days`` leaves out events whose id is known within so many days of their own; late events are stored like others.
    Dead letters are written before events, both under the batch's number.
    """
    order = EVENT_CLUSTER if cluster is None else cluster
    required = required or EVENT_REQUIRED
    missing = F.when(~all_of([F.col(name).isNotNull() for name in required]), _missing(required))

    def handle(batch: DataFrame, number: int) -> None:
        checked = _checked(batch, schema, "value", id_field).withColumn(_REASON, F.coalesce(_REASON, missing))
        # The message is only needed where it is dead.
        rows = checked.withColumn(_MESSAGE, F.when(F.col(_REASON).isNotNull(), F.col(_MESSAGE).cast("binary"))).persist()
        try:
            counts = rows.agg(F.count(_REASON), F.count("*")).first()
            if counts[0]:
                dead = rows.filter(F.col(_REASON).isNotNull()).select(F.col(_MESSAGE).alias("message"), F.col(_REASON).alias("reason"))
                _write_batch(dead, paths.dead, number, counts[0], [], ["reason", "message"])
            if counts[1] > counts[0]:
                good = rows.filter(F.col(_REASON).isNull()).select(*schema.names)
                _store(good, paths.events, number, counts[1] - counts[0], ts, order, id_field if dedupe_days is not None else None,
                       dedupe_days or 0)
        finally:
            rows.unpersist()

    return [_each_batch(messages, paths.checkpoint("ingest"), trigger, handle)]


def run_to_end(queries: list[StreamingQuery]) -> None:
    """Wait for bounded runs (``availableNow``) to finish; an error in a query is raised here."""
    for query in queries:
        query.awaitTermination()

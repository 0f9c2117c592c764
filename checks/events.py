"""Event ingest. Messages are built from the events table; some are broken on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import as_text, query, table
from reelmill.session import fresh_path
from reelmill.streaming import events as E

COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def messages(events: DataFrame) -> DataFrame:
    """JSON messages as bytes. Errors are cut short, clicks of user 7 and below have no id, sign-ups
    have no content, every second hour has a zone mark."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    known = (F.col("event_type") != "click") | (F.col("user_id") > 7)
    event = F.struct(
        F.when(known, F.concat(F.lit("evt_"), F.col("event_id").cast("string"))).alias("event_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_type") != "signup", F.get_json_object("props", "$.k")).alias("content_id"),
        "event_type",
        F.when(F.hour("ts") % 2 == 0, F.concat(time, F.lit("Z"))).otherwise(time).alias("timestamp"),
        F.floor("value").alias("position"),
        F.struct(F.col("event_type").alias("type"), F.lit("Linux").alias("os")).alias("device"),
        F.struct(F.lit("HD").alias("resolution"), (F.col("user_id") * 100).alias("bitrate")).alias("quality"),
        F.lit("x").alias("unknown_field"),
        F.from_json("props", "k long").alias("extra_attributes"),
    )
    text = F.to_json(event)
    broken = F.when(F.col("event_type") == "error", F.regexp_replace(text, r"\}$", "")).otherwise(text)
    return events.select(broken.cast("binary").alias("value"))


def static_messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages(table(spark, folder, "events"))


def streamed_events(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    # A file source lists a glob; this one matches the events file alone.
    return E.read_event_stream(spark, "parquet", path=f"{folder}/event[s].parquet", schema=schema)


PARSED = """
SELECT 'evt_' || event_id AS event_id, 'user_' || user_id AS user_id,
       CASE WHEN event_type <> 'signup' THEN CAST(props->>'$.k' AS VARCHAR) END AS content_id, event_type,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, CAST(floor(value) AS BIGINT) AS position, 'HD' AS quality_resolution,
       user_id * 100 AS quality_bitrate, event_type AS device_type
FROM events WHERE event_type <> 'error' AND (event_type <> 'click' OR user_id > 7)
"""

SHOWN = ["event_id", "user_id", "content_id", "event_type", "event_date", "position", "quality_resolution",
         "quality_bitrate", "device_type"]


def shown(events: DataFrame) -> DataFrame:
    dated = E.flatten_event(events).withColumn("event_date", F.to_date("timestamp"))
    return as_text(dated.select(*SHOWN), "event_date")


@query("read_event_stream", """
SELECT event_type, count(*) AS n, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM events GROUP BY event_type
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "stream")
    E.run_to_end([E.append_events(streamed_events(spark, folder), f"{path}/out", f"{path}/checkpoint", ts="ts")])
    stored = spark.read.parquet(f"{path}/out").groupBy("event_type")
    return stored.agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("parse_events", PARSED)
def _(spark: SparkSession, folder: str) -> DataFrame:
    good, _dead = E.parse_events(static_messages(spark, folder))
    return shown(good)


@query("parse_events_dead", """
SELECT CASE WHEN event_type = 'error' THEN 'malformed' ELSE 'no event_id' END AS reason, count(*) AS n FROM events
WHERE event_type = 'error' OR (event_type = 'click' AND user_id <= 7) GROUP BY 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    _good, dead = E.parse_events(static_messages(spark, folder))
    return dead.groupBy("reason").agg(F.count("*").alias("n"))


@query("enforce_required", """
SELECT event_id, CAST(CASE WHEN user_id <= 50 THEN user_id END AS VARCHAR) AS user_id,
       CASE WHEN event_type = 'signup' AND user_id > 50 THEN 'missing user_id,event_type'
       WHEN event_type = 'signup' THEN 'missing event_type' WHEN user_id > 50 THEN 'missing user_id' END AS reason
FROM events
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events", "event_id", "user_id", "event_type")
    holed = events.withColumns({
        "user_id": F.when(F.col("user_id") <= 50, F.col("user_id")),
        "event_type": F.when(F.col("event_type") != "signup", F.col("event_type")),
    })
    good, dead = E.enforce_required(holed, ["event_id", "user_id", "event_type"])
    marked = good.withColumn("reason", F.lit(None).cast("string")).unionByName(dead)
    return as_text(marked.select("event_id", "user_id", "reason"), "user_id")


@query("flatten_event", PARSED.replace("WHERE", "WHERE event_type <> 'signup' AND"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    good, _dead = E.enforce_required(E.parse_events(static_messages(spark, folder))[0])
    return shown(good)


@query("append_events", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "stream")
    for _run in range(2):
        E.run_to_end([E.append_events(streamed_events(spark, folder), f"{path}/out", f"{path}/checkpoint", ts="ts")])
    stored = spark.read.parquet(f"{path}/out").groupBy("event_date")
    return as_text(stored.agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value")), "event_date")


@query("dedupe_events", "SELECT event_id, user_id, event_type FROM events")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "stream")
    twice = streamed_events(spark, folder).unionByName(streamed_events(spark, folder))
    E.run_to_end([E.append_events(twice, f"{path}/out", f"{path}/checkpoint", ts="ts", unique="event_id")])
    return spark.read.parquet(f"{path}/out").select("event_id", "user_id", "event_type")


@query("event_ingest", """
SELECT 'stored' AS outcome, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type, count(*) AS n FROM events
WHERE event_type NOT IN ('error', 'signup') AND (event_type <> 'click' OR user_id > 7) GROUP BY 2, 3
UNION ALL SELECT 'malformed', NULL, NULL, count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'no event_id', NULL, NULL, count(*) FROM events WHERE event_type = 'click' AND user_id <= 7
UNION ALL SELECT 'missing content_id', NULL, NULL, count(*) FROM events WHERE event_type = 'signup'
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    paths = E.IngestPaths(fresh_path(spark, "ingest"))
    E.run_to_end(E.event_ingest(messages(streamed_events(spark, folder)), paths, dedupe_days=7))
    stored = spark.read.parquet(paths.events).groupBy("event_date", "event_type").agg(F.count("*").alias("n"))
    dead = spark.read.parquet(paths.dead).groupBy("reason").agg(F.count("*").alias("n"))
    kept = as_text(stored.select(F.lit("stored").alias("outcome"), "event_date", "event_type", "n"), "event_date")
    nothing = F.lit(None).cast("string")
    rejected = dead.select(F.col("reason").alias("outcome"), nothing.alias("event_date"), nothing.alias("event_type"), "n")
    return kept.unionByName(rejected)

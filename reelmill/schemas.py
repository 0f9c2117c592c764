"""Explicit schemas: raw dumps are all strings, curated tables and events are typed."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column order of the seven raw dumps.
RAW = {
    "title_basics": _strings(
        "tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
        "startYear", "endYear", "runtimeMinutes", "genres",
    ),
    "title_ratings": _strings("tconst", "averageRating", "numVotes"),
    "title_crew": _strings("tconst", "directors", "writers"),
    "title_episode": _strings("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
    "title_principals": _strings("tconst", "ordering", "nconst", "category", "job", "characters"),
    "title_akas": _strings(
        "titleId", "ordering", "title", "region", "language", "types", "attributes", "isOriginalTitle"
    ),
    "name_basics": _strings(
        "nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"
    ),
}

# Types of the curated columns that are not strings.
TYPED = {
    "title_basics": {"isAdult": "boolean", "startYear": "int", "endYear": "int", "runtimeMinutes": "int"},
    "title_ratings": {"averageRating": "double", "numVotes": "int"},
    "title_crew": {},
    "title_episode": {"seasonNumber": "int", "episodeNumber": "int"},
    "title_principals": {"ordering": "int"},
    "title_akas": {"ordering": "int", "isOriginalTitle": "boolean"},
    "name_basics": {"birthYear": "int", "deathYear": "int"},
}

# The key of each curated table.
KEYS = {
    "title_basics": ["tconst"],
    "title_ratings": ["tconst"],
    "title_crew": ["tconst"],
    "title_episode": ["tconst"],
    "title_principals": ["tconst", "ordering"],
    "title_akas": ["titleId", "ordering"],
    "name_basics": ["nconst"],
}


_KINDS = {"string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "double": T.DoubleType()}


def curated_schema(table: str) -> T.StructType:
    """The schema a curated table must have before it is written."""
    typed = TYPED[table]
    return T.StructType([T.StructField(f.name, _KINDS[typed.get(f.name, "string")]) for f in RAW[table]])


EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("duration", T.LongType()),
    T.StructField("position", T.LongType()),
    T.StructField("device", _strings("type", "os", "browser", "model")),
    T.StructField("location", _strings("country", "region", "city")),
    T.StructField("quality", T.StructType([
        T.StructField("resolution", T.StringType()),
        T.StructField("bitrate", T.LongType()),
    ])),
    T.StructField("rating", T.LongType()),
    T.StructField("extra_attributes", T.StringType()),
])

# Fields an event must carry, and the sort order inside a day.
EVENT_REQUIRED = ["event_id", "user_id", "content_id", "event_type", "timestamp"]
EVENT_CLUSTER = ["user_id", "content_id", "event_type"]

INGESTION_LOG = T.StructType([
    T.StructField("dataset_name", T.StringType()),
    T.StructField("ingestion_date", T.TimestampType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("md5_hash", T.StringType()),
    T.StructField("has_changed", T.BooleanType()),
])

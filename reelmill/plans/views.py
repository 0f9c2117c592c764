"""The two reporting views over curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.columns import array_is_empty, split_to_array
from reelmill.operators.joins import left_on_key
from reelmill.operators.profile import quality_metrics


def content_performance(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every title with its rating and votes, if it has any."""
    titles = basics.select("tconst", "primaryTitle", "titleType", "startYear", "genres")
    rated = left_on_key(titles, ratings.select("tconst", "averageRating", "numVotes"), "tconst")
    return rated.select(
        "tconst", "primaryTitle", "titleType", "startYear", "averageRating", "numVotes", "genres"
    )


def data_quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, missing titles and missing genre lists of each table; 0 where a table has no such column."""
    wanted = {}
    for name, frame in tables.items():
        metrics = {"missing_titles": F.lit(False), "missing_genres": F.lit(False)}
        if "primaryTitle" in frame.columns:
            metrics["missing_titles"] = F.col("primaryTitle").isNull()
        if "genres" in frame.columns:
            metrics["missing_genres"] = array_is_empty(split_to_array(F.col("genres")))
        wanted[name] = (frame, metrics)
    return quality_metrics(wanted)

"""Runtimes by genre, by category and by group, and the longest and shortest titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.columns import NULL_MARKER, decade, labelled, left_closed_bucket
from reelmill.operators.joins import chain_join, semi_in_set
from reelmill.operators.ordered import OrderedValues, order_values
from reelmill.operators.profile import distribution
from reelmill.operators.ranking import arg_extremes, keep_frequent, reorder_fill, sample_rows, top_n
from reelmill.operators.shaping import drop_missing, null_marker_filter, range_filter, to_numeric
from reelmill.operators.summaries import (
    crosstab,
    describe_column,
    grouped_mean,
    histogram,
    min_support,
)
from reelmill.plans.genres import MIN_VOTES, RATING_RANGE, TOP_GENRES, TOP_GENRES_SHORT, genre_rows
from reelmill.plans.ratings import ADULT_LABELS

# Usable runtimes in minutes, what a genre needs to count, categories, first decade.
RUNTIME_RANGE, LONG_RUNTIME_RANGE = (1, 600), (1, 1000)
MIN_GENRE_TITLES = 100
RUNTIME_EDGES = [30, 60, 90, 120]
RUNTIME_CATEGORIES = [
    "Short (<30m)", "Medium (30-60m)", "Standard (60-90m)", "Long (90-120m)", "Very Long (>120m)",
]
FIRST_DECADE = 1950
MOVIE, SERIES = "movie", "tvSeries"
RUNTIME_BINS = 50
SCATTER_SIZE, SCATTER_SEED = 2000, 42


def runtime_genre_rows(basics: DataFrame, sep: str = ",") -> DataFrame:
    """One row per title and genre for titles with a usable runtime."""
    marked = null_marker_filter(
        basics.withColumn("runtimeMinutes", F.col("runtimeMinutes").cast("string")), ["genres", "runtimeMinutes"]
    )
    usable = range_filter(
        drop_missing(to_numeric(marked, ["runtimeMinutes"]), ["runtimeMinutes"]), {"runtimeMinutes": RUNTIME_RANGE}
    )
    return genre_rows(usable, ["tconst", "titleType", "runtimeMinutes"], sep)


def genre_runtime_stats(
    ordered: OrderedValues, min_titles: int = MIN_GENRE_TITLES, top: int = TOP_GENRES
) -> DataFrame:
    """Count, mean, median, spread and range of the runtime of the most frequent genres."""
    stats = ordered.statistics({"median": 0.5}).select("genre", "count", "mean", "median", "std", "min", "max")
    return top_n(min_support(stats, {"count": min_titles}), "count", top, tie=["genre"])


def genre_vs_runtime(basics: DataFrame, sep: str = ",", min_titles: int = MIN_GENRE_TITLES) -> dict[str, DataFrame]:
    """Runtime statistics per genre. Summary and quartiles share one pass over the exploded rows."""
    rows = runtime_genre_rows(basics, sep)
    ordered = order_values(rows, ["genre"], ["runtimeMinutes"])
    stats = genre_runtime_stats(ordered, min_titles)
    short = top_n(stats, "count", TOP_GENRES_SHORT, tie=["genre"]).select("genre")
    return {
        "stats": stats,
        "boxes": semi_in_set(ordered.box(), short, ["genre"]),
        "longest": top_n(stats, "mean", 1, tie=["genre"]),
        "shortest": top_n(stats, "mean", 1, desc=False, tie=["genre"]),
        "most_variable": top_n(stats, "std", 3, tie=["genre"]),
    }


def runtime_titles(basics: DataFrame) -> DataFrame:
    """Titles with genres and a usable runtime, one row each."""
    numbers = to_numeric(null_marker_filter(basics, ["genres"]), ["runtimeMinutes"])
    return range_filter(drop_missing(numbers, ["runtimeMinutes"]), {"runtimeMinutes": RUNTIME_RANGE})


def overall_runtime(basics: DataFrame) -> DataFrame:
    return describe_column(runtime_titles(basics), "runtimeMinutes")


def with_category(rows: DataFrame) -> DataFrame:
    category = left_closed_bucket(F.col("runtimeMinutes"), RUNTIME_EDGES, RUNTIME_CATEGORIES)
    return rows.withColumn("runtime_category", category)


def frequent_genre_rows(rows: DataFrame, min_titles: int = MIN_GENRE_TITLES, top: int = TOP_GENRES) -> DataFrame:
    """The rows of the most frequent genres with enough titles, which the category figures are made from."""
    return keep_frequent(rows, "genre", top, min_titles)


def category_counts(rows: DataFrame) -> DataFrame:
    """Rows per runtime category in their natural order, empty ones included."""
    counts = distribution(with_category(rows), "runtime_category", drop_null_keys=True)
    return reorder_fill(counts, "runtime_category", RUNTIME_CATEGORIES, {"n": 0})


def category_percentages(rows: DataFrame, top: int = TOP_GENRES_SHORT) -> DataFrame:
    """Runtime categories of the most frequent genres, each row in percent."""
    kept = with_category(keep_frequent(rows, "genre", top))
    names = ["short", "medium", "standard", "long", "very_long"]
    return crosstab(kept, "genre", "runtime_category", RUNTIME_CATEGORIES, names, normalize="row")


def runtime_categories(
    rows: DataFrame, min_titles: int = MIN_GENRE_TITLES, top: int = TOP_GENRES, shown: int = TOP_GENRES_SHORT
) -> dict[str, DataFrame]:
    """Categories over the ``top`` genres with enough titles, and their percentages in the first ``shown`` of them."""
    kept = frequent_genre_rows(rows, min_titles, top)
    return {"counts": category_counts(kept), "percentages": category_percentages(kept, shown)}


def original_titles(akas: DataFrame, unique: bool = False) -> DataFrame:
    """Original titles as ``tconst, title``. A title may have several and then multiplies the rows it is
    joined to; ``unique`` keeps the first in alphabetical order."""
    originals = akas.filter(F.col("isOriginalTitle")).select(F.col("titleId").alias("tconst"), "title")
    return originals.groupBy("tconst").agg(F.min("title").alias("title")) if unique else originals


def titled_runtimes(
    basics: DataFrame, ratings: DataFrame, akas: DataFrame, unique_originals: bool = False
) -> DataFrame:
    """Rated titles with a usable runtime, rating and votes, and with their original title."""
    columns = ["tconst", "titleType", "genres", "runtimeMinutes", "isAdult", "startYear", "endYear"]
    joined = chain_join(
        basics.select(*columns),
        [
            (ratings.select("tconst", "averageRating", "numVotes"), "tconst", "inner"),
            (original_titles(akas, unique_originals), "tconst", "left"),
        ],
    )
    kept = joined.filter(F.col("genres").isNull() | (F.col("genres") != NULL_MARKER))
    numbers = to_numeric(kept, ["runtimeMinutes", "averageRating", "numVotes", "startYear", "endYear"])
    usable = range_filter(
        drop_missing(numbers, ["titleType", "runtimeMinutes", "averageRating", "numVotes"]),
        {"runtimeMinutes": LONG_RUNTIME_RANGE, "averageRating": RATING_RANGE, "numVotes": (MIN_VOTES, None)},
    )
    flagged = usable.withColumn("isAdult", F.col("isAdult").try_cast("int"))
    return flagged.withColumn("adult_label", labelled(F.col("isAdult"), ADULT_LABELS))


def extreme_runtimes(titles: DataFrame) -> DataFrame:
    """The longest and the shortest movie, and the same for series with and without the adult flag."""
    series = F.when(F.col("isAdult") == 1, "series_adult").when(F.col("isAdult") == 0, "series_non_adult")
    kind = F.when(F.col("titleType") == MOVIE, "movie").when(F.col("titleType") == SERIES, series)
    grouped = titles.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    return arg_extremes(grouped, "runtimeMinutes", ["kind"], ["tconst", "title"], ("longest", "shortest"))


def runtime_by_group(titles: DataFrame) -> dict[str, DataFrame]:
    """Runtime histograms and samples of movies and series, means by class and by decade."""
    shown = titles.filter(F.col("titleType").isin(MOVIE, SERIES))
    movies = titles.filter((F.col("titleType") == MOVIE) & F.col("startYear").isNotNull())
    decades = grouped_mean(movies.withColumn("decade", decade(F.col("startYear"))), ["decade"], "runtimeMinutes")
    return {
        "histogram": histogram(shown, "runtimeMinutes", RUNTIME_BINS, ["titleType"]),
        "means": grouped_mean(shown, ["titleType", "adult_label"], "runtimeMinutes"),
        "decades": min_support(decades, {"decade": FIRST_DECADE}),
        "movie_sample": sample_rows(titles.filter(F.col("titleType") == MOVIE), SCATTER_SIZE, SCATTER_SEED, ["tconst"]),
        "series_sample": sample_rows(titles.filter(F.col("titleType") == SERIES), SCATTER_SIZE, SCATTER_SEED, ["tconst"]),
    }

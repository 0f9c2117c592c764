"""Genres against the adult flag, and genres against ratings and votes."""

from __future__ import annotations

from functools import cache, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.columns import NULL_MARKER, log_measure
from reelmill.operators.joins import inner_on_key, semi_in_set
from reelmill.operators.lists import explode_list
from reelmill.operators.ranking import keep_frequent, sample_rows, top_n
from reelmill.operators.shaping import drop_missing, null_marker_filter, range_filter, to_numeric
from reelmill.operators.summaries import (
    crosstab,
    flag_rate,
    histogram,
    min_support,
    multi_summary,
    quadrant_label,
    segment_above_below,
    split_totals,
    spread_labels,
)
from reelmill.plans.outputs import Outputs
from reelmill.session import materialize

# How many genres are looked at, and what a genre or a title needs to count.
TOP_GENRES, TOP_GENRES_SHORT, TOP_ADULT, TOP_HISTOGRAMS = 15, 10, 5, 6
MIN_RATED_TITLES = 50
RATING_RANGE, MIN_VOTES = (1.0, 10.0), 5
SCATTER_SIZE, SCATTER_SEED = 5000, 42

# What is computed per genre, and labels of the spread of its ratings.
GENRE_STATS = {
    "averageRating": ["count", "mean", "median", "std"],
    "numVotes": ["mean", "median", "std"],
    "log_numVotes": ["mean", "std"],
}
SPREAD_CUTS = (1.0, 1.2)
SPREAD_LABELS = ("Very Consistent", "Moderately Consistent", "Variable")


def genre_rows(titles: DataFrame, keys: list[str], sep: str = ",") -> DataFrame:
    """One row per title and genre, blanks stripped, empty genres and titles without genres left out."""
    listed = null_marker_filter(titles, ["genres"])
    return explode_list(listed, keys, "genres", "genre", sep, trim=True, drop_empty=True, skip=(NULL_MARKER,))


def adult_genre_rows(basics: DataFrame, sep: str = ",") -> DataFrame:
    flagged = basics.withColumn("isAdult", F.col("isAdult").try_cast("int"))
    return genre_rows(flagged, ["tconst", "isAdult"], sep)


def genre_adult_rates(rows: DataFrame, top: int = TOP_GENRES) -> DataFrame:
    """Titles, adult titles and adult share of the most frequent genres.

    All genres are counted in one aggregate and the top ones are picked from the counts, so the
    exploded rows are read and shuffled once.
    """
    support = rows.groupBy("genre").agg(
        F.count("*").alias("rows"), F.count("isAdult").alias("n"), F.sum("isAdult").cast("long").alias("flagged")
    )
    best = top_n(support, "rows", top, tie=["genre"])
    share = F.try_divide(F.col("flagged").cast("double"), F.col("n").cast("double"))
    return best.select("genre", "n", "flagged", share.alias("share"), (share * 100).alias("pct"))


def genre_adult_table(rows: DataFrame, top: int = TOP_GENRES, normalize: str | None = None) -> DataFrame:
    """Genre by class, for the most frequent genres."""
    kept = keep_frequent(rows, "genre", top)
    names = ["non_adult", "adult"]
    total = None if normalize else "total"
    return crosstab(kept, "genre", "isAdult", [0, 1], names, total=total, normalize=normalize)


def genre_vs_adult(basics: DataFrame, sep: str = ",") -> dict[str, DataFrame]:
    rows = adult_genre_rows(basics, sep)
    listed = null_marker_filter(basics, ["genres"])
    flag = F.col("isAdult").try_cast("int")
    rates = genre_adult_rates(rows)
    return {
        "rates": rates,
        "counts": genre_adult_table(rows),
        "percentages": genre_adult_table(rows, normalize="row"),
        "short_counts": genre_adult_table(rows, TOP_GENRES_SHORT),
        "totals": split_totals(listed, {"adult": flag == 1, "non_adult": flag == 0}),
        "most_adult": top_n(rates.filter(F.col("pct") > 0), "pct", TOP_ADULT, tie=["genre"]),
        "classes": flag_rate(rows, [], "isAdult"),
    }


def rated_titles(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Titles with genres, a usable rating and enough votes, one row each."""
    joined = inner_on_key(
        basics.select("tconst", "genres"), ratings.select("tconst", "averageRating", "numVotes"), "tconst"
    )
    numbers = to_numeric(null_marker_filter(joined, ["genres"]), ["averageRating", "numVotes"])
    return range_filter(
        drop_missing(numbers, ["averageRating", "numVotes"]),
        {"averageRating": RATING_RANGE, "numVotes": (MIN_VOTES, None)},
    )


def rated_genre_rows(basics: DataFrame, ratings: DataFrame, sep: str = ",") -> DataFrame:
    """One row per rated title and genre, with rating, votes and the logarithm of the votes."""
    rows = genre_rows(rated_titles(basics, ratings), ["tconst", "averageRating", "numVotes"], sep)
    return rows.withColumn("log_numVotes", log_measure(F.col("numVotes")))


def genre_rating_stats(
    rows: DataFrame, min_titles: int = MIN_RATED_TITLES, top: int = TOP_GENRES
) -> DataFrame:
    """Rating and vote statistics of the most frequent genres."""
    stats = multi_summary(rows, ["genre"], GENRE_STATS)
    supported = min_support(stats, {"averageRating_count": min_titles})
    return top_n(supported, "averageRating_count", top, tie=["genre"])


def genre_quadrants(stats: DataFrame) -> DataFrame:
    """Each genre as high or low in rating and in votes, against the medians of the genres."""
    return quadrant_label(stats, "averageRating_mean", "numVotes_mean")


# What ranks genres, per list: the statistic, how many, whether the largest come first, and the segment or labels it needs.
RANKINGS = {
    "highest_rated": ("averageRating_mean", 3, True, None),
    "most_voted": ("numVotes_mean", 3, True, None),
    "most_consistent": ("averageRating_std", 3, False, None),
    "quality_leaders": ("averageRating_mean", 5, True, "labels"),
    "popular": ("numVotes_mean", 5, True, None),
    "hidden_gems": ("averageRating_mean", 3, True, "hidden_gem"),
    "mass_appeal": ("numVotes_mean", 3, True, "mass_appeal"),
    "consistency_champions": ("averageRating_std", 5, False, "labels"),
}


def genre_ranking(stats: DataFrame, name: str) -> DataFrame:
    """A short list of genres by their statistics, or of the genres that stand out."""
    statistic, n, largest, needs = RANKINGS[name]
    if needs == "labels":
        stats = spread_labels(stats, "averageRating_std", SPREAD_CUTS, SPREAD_LABELS, "consistency")
    elif needs:
        stats = segment_above_below(stats, "averageRating_mean", "numVotes_mean").filter(F.col("segment") == needs)
    return top_n(stats, statistic, n, desc=largest, tie=["genre"])


def genre_histogram(rows: DataFrame, stats: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """A histogram for each of the most frequent genres."""
    leading = top_n(stats, "averageRating_count", TOP_HISTOGRAMS, tie=["genre"]).select("genre")
    return histogram(semi_in_set(rows, leading, ["genre"]), col, bins, ["genre"])


def rated_overall(titles: DataFrame, rows: DataFrame) -> DataFrame:
    """One row over all rated titles: titles, genres, mean rating, mean and median votes."""
    summary = multi_summary(titles, [], {"averageRating": ["count", "mean"], "numVotes": ["mean", "median"]})
    genres = rows.agg(F.count_distinct("genre")).scalar()
    return summary.select(
        F.col("averageRating_count").alias("titles"), genres.alias("genres"), F.col("averageRating_mean").alias("mean_rating"),
        F.col("numVotes_mean").alias("mean_votes"), F.col("numVotes_median").alias("median_votes"),
    )


def genre_rating_votes(basics: DataFrame, ratings: DataFrame, sep: str = ",") -> Outputs:
    """Everything about genres, ratings and votes, each output when it is asked for. The statistics, a row per leading genre,
    are stored once, and all lists come from them; the sample is one of titles for a scatter plot."""
    rows = rated_genre_rows(basics, ratings, sep)

    @cache
    def stats() -> DataFrame:
        return materialize(genre_rating_stats(rows))

    def sample() -> DataFrame:
        kept = semi_in_set(rows, stats().select("genre"), ["genre"])
        return sample_rows(kept, SCATTER_SIZE, SCATTER_SEED, ["tconst", "genre"])

    return Outputs({
        "overall": lambda: rated_overall(rated_titles(basics, ratings), rows),
        "stats": stats,
        "quadrants": lambda: genre_quadrants(stats()),
        **{name: partial(lambda which: genre_ranking(stats(), which), name) for name in RANKINGS},
        "ratings": lambda: genre_histogram(rows, stats(), "averageRating"),
        "votes": lambda: genre_histogram(rows, stats(), "log_numVotes"),
        "sample": sample,
    })



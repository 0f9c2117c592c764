"""Ratings of adult against other titles, and the profile of one class alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.columns import labelled, right_closed_bucket
from reelmill.operators.joins import inner_on_key
from reelmill.operators.ordered import ecdf, order_values
from reelmill.operators.profile import distribution_share
from reelmill.operators.summaries import (
    describe_column,
    grouped_mean_std,
    grouped_summary,
    histogram,
    split_totals,
    two_sample_t,
)
from reelmill.plans.outputs import Outputs

# Labels of the adult flag, rating ranges, and the bounds of high and low ratings.
ADULT_LABELS = {0: "Non-Adult", 1: "Adult"}
RATING_EDGES = [0, 3, 5, 7, 10]
RATING_RANGES = ["Poor (1-3)", "Fair (3-5)", "Good (5-7)", "Excellent (7-10)"]
HIGH_RATING, LOW_RATING = 7.0, 5.0
RATING_BINS = 30


def rated_titles(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Titles that have a rating, with the adult flag as 0/1 and as a label."""
    flagged = basics.select("tconst", F.col("isAdult").try_cast("int").alias("isAdult"))
    joined = inner_on_key(flagged, ratings.select("tconst", "averageRating"), "tconst")
    return joined.withColumn("adult_label", labelled(F.col("isAdult"), ADULT_LABELS))


def adult_vs_rating(rated: DataFrame) -> Outputs:
    """Summary, shares, means, histograms and quartiles per class, and a t-test between the classes."""
    by = ["adult_label"]
    return Outputs({
        "summary": lambda: grouped_summary(rated, by, "averageRating"),
        "shares": lambda: distribution_share(rated, "adult_label"),
        "means": lambda: grouped_mean_std(rated, by, "averageRating"),
        "histogram": lambda: histogram(rated, "averageRating", RATING_BINS, by),
        "boxes": lambda: order_values(rated, by, ["averageRating"]).box(),
        "t_test": lambda: two_sample_t(rated, "isAdult", "averageRating", 0, 1),
    })


def rating_ranges(rated: DataFrame) -> DataFrame:
    """Share of each named rating range; ratings outside all ranges are left out."""
    ranged = rated.withColumn(
        "rating_range", right_closed_bucket(F.col("averageRating"), RATING_EDGES, RATING_RANGES)
    )
    return distribution_share(ranged, "rating_range")


def high_low_shares(rated: DataFrame) -> DataFrame:
    rating = F.col("averageRating")
    return split_totals(rated, {"high": rating >= HIGH_RATING, "low": rating < LOW_RATING})


def single_class_profile(rated: DataFrame) -> Outputs:
    """The ratings of titles that are all of one class."""
    return Outputs({
        "histogram": lambda: histogram(rated, "averageRating", RATING_BINS),
        "boxes": lambda: order_values(rated, [], ["averageRating"]).box().drop("_all"),
        "ranges": lambda: rating_ranges(rated),
        "ecdf": lambda: ecdf(rated, "averageRating"),
        "description": lambda: describe_column(rated, "averageRating"),
        "high_low": lambda: high_low_shares(rated),
    })

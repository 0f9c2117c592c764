"""Directors and writers ranked by weighted score, by rating, by votes and by consistency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.columns import NULL_MARKER, weighted_score
from reelmill.operators.joins import chain_join, detail_lookup, left_renamed_keys, lookup_default, semi_in_set
from reelmill.operators.lists import NO_PEOPLE, element_frequencies, explode_list, format_counts
from reelmill.operators.profile import distinct_values, distribution
from reelmill.operators.ranking import rank_rows, top_n, top_n_per_group
from reelmill.operators.shaping import drop_missing, null_marker_filter, range_filter, to_numeric
from reelmill.operators.summaries import min_support, multi_summary
from reelmill.plans.genres import RATING_RANGE
from reelmill.session import materialize

# What a person or a title needs to count, and the lengths of the lists.
MIN_WORKS, MIN_MEAN_VOTES, MIN_TITLE_VOTES = 3, 100, 10
TOP_PEOPLE, DETAIL_LENGTH, DETAILED_PEOPLE, BEST_WORKS = 10, 5, 3, 3

# Statistics per person in the two rankings.
WEIGHTED_STATS = {
    "averageRating": ["count", "mean", "std"],
    "numVotes": ["mean", "sum"],
    "weighted_score": ["mean"],
    "isOriginal": ["mean"],
}
RATING_STATS = {
    "averageRating": ["count", "mean", "std"],
    "numVotes": ["sum", "mean"],
    "isOriginal": ["mean"],
}


def originals(akas: DataFrame, unique: bool = False) -> DataFrame:
    """Titles that have an original title, as ``tconst, isOriginal``; once per alternative title unless
    ``unique``, so a title with two of them counts twice in a join."""
    flagged = akas.filter(F.col("isOriginalTitle")).select(F.col("titleId").alias("tconst"))
    return (flagged.distinct() if unique else flagged).withColumn("isOriginal", F.lit(1))


def credited_works(titles: DataFrame, role: str) -> DataFrame:
    """One row per title and person of a crew column (``directors`` or ``writers``)."""
    keys = ["tconst", "genres", "averageRating", "numVotes", "isOriginal"]
    return explode_list(titles, keys, role, "person_id", trim=True, skip=NO_PEOPLE)


def weighted_works(
    basics: DataFrame,
    crew: DataFrame,
    ratings: DataFrame,
    akas: DataFrame,
    principals: DataFrame | None,
    role: str,
    unique_originals: bool = False,
    skewed_roles: bool = False,
) -> DataFrame:
    """Rated works of each person with a weighted score.

    A person with several roles in a title appears once per role, as in the ranking this feeds.
    ``skewed_roles`` is for principals of which one title and person hold a large part.
    """
    joined = chain_join(
        basics.select("tconst", "genres"),
        [
            (crew.select("tconst", role), "tconst", "left"),
            (ratings.select("tconst", "averageRating", "numVotes"), "tconst", "inner"),
            (originals(akas, unique_originals), "tconst", "left"),
        ],
    )
    kept = joined.na.fill({"isOriginal": 0}).filter(F.col("genres").isNull() | (F.col("genres") != NULL_MARKER))
    numbers = to_numeric(kept, ["averageRating", "numVotes"])
    works = credited_works(drop_missing(numbers, ["averageRating", "numVotes"]), role)
    if principals is not None:
        roles = principals.select("tconst", "nconst", "category", "characters")
        works = left_renamed_keys(works, roles, {"tconst": "tconst", "person_id": "nconst"}, skewed_roles)
    return works.withColumn("weighted_score", weighted_score(F.col("averageRating"), F.col("numVotes")))


def talent_weighted(
    works: DataFrame,
    min_works: int = MIN_WORKS,
    min_votes: float = MIN_MEAN_VOTES,
    top: int = TOP_PEOPLE,
    count_distinct_titles: bool = False,
) -> DataFrame:
    """The people with the best mean weighted score, with their rank.

    ``count_distinct_titles`` counts a title once per person, however many roles it has.
    """
    rows = works
    if count_distinct_titles:
        rows = works.select("person_id", "tconst", *WEIGHTED_STATS).distinct()
    stats = multi_summary(rows, ["person_id"], WEIGHTED_STATS)
    qualified = min_support(stats, {"averageRating_count": min_works, "numVotes_mean": min_votes})
    return rank_rows(qualified, "weighted_score_mean", top, tie=["person_id"])


def leader_details(works: DataFrame, ranked: DataFrame) -> dict[str, DataFrame]:
    """Genres, categories, characters and best works of the first in the ranking.

    The works of the leader are stored once, so that the joins behind them do not run for each detail.
    """
    leader = ranked.filter(F.col("rank") == 1).select("person_id")
    own = materialize(semi_in_set(works, leader, ["person_id"]))
    return {
        "genres": element_frequencies(own, "genres", DETAIL_LENGTH, out="genre"),
        "categories": distribution(own, "category", DETAIL_LENGTH, drop_null_keys=True),
        "characters": distinct_values(own, "characters", n=DETAIL_LENGTH, marker=NULL_MARKER),
        # a title counts once here, however many roles the leader has in it
        "best_works": top_n(own.drop("category", "characters").distinct(), "averageRating", DETAIL_LENGTH, tie=["tconst"]),
    }


def rated_works(
    ratings: DataFrame, basics: DataFrame, crew: DataFrame, akas: DataFrame, role: str,
    unique_originals: bool = False,
) -> DataFrame:
    """Works of each person among titles with enough votes and with genres."""
    numbers = drop_missing(to_numeric(ratings, ["averageRating", "numVotes"]), ["averageRating", "numVotes"])
    usable = range_filter(numbers, {"averageRating": RATING_RANGE, "numVotes": (MIN_TITLE_VOTES, None)})
    listed = null_marker_filter(basics.select("tconst", "genres"), ["genres"])
    joined = chain_join(
        usable.select("tconst", "averageRating", "numVotes"),
        [
            (listed, "tconst", "inner"),
            (crew.select("tconst", role), "tconst", "left"),
            (originals(akas, unique_originals), "tconst", "left"),
        ],
    )
    return credited_works(joined.na.fill({"isOriginal": 0}), role)


def person_stats(works: DataFrame, min_works: int = MIN_WORKS) -> DataFrame:
    stats = multi_summary(works, ["person_id"], RATING_STATS)
    return min_support(stats, {"averageRating_count": min_works})


def talent_by_rating(stats: DataFrame, names: DataFrame, top: int = TOP_PEOPLE) -> DataFrame:
    """The best people by mean rating with rank and name. Only their names are read from the name table."""
    ranked = rank_rows(stats, "averageRating_mean", top, tie=["person_id"])
    ids = ranked.select(F.col("person_id").alias("nconst"))
    needed = semi_in_set(names.select("nconst", "primaryName"), ids, ["nconst"])
    return lookup_default(ranked, needed, "person_id", "nconst", "primaryName", "Unknown", "name")


def talent_by_votes(stats: DataFrame, top: int = TOP_PEOPLE) -> DataFrame:
    return top_n(stats, "numVotes_sum", top, tie=["person_id"])


def talent_by_consistency(stats: DataFrame, top: int = TOP_PEOPLE) -> DataFrame:
    """Lowest spread of ratings first; a person without a spread comes last."""
    return top_n(stats, "averageRating_std", top, desc=False, tie=["person_id"])


def talent_details(works: DataFrame, ranked: DataFrame, principals: DataFrame) -> dict[str, DataFrame]:
    """Genres, best works, categories and characters of the leading people, one job for all of them.

    Their works are stored once, so that the joins behind them do not run for each detail.
    """
    leaders = ranked.filter(F.col("rank") <= DETAILED_PEOPLE).select("person_id")
    own = materialize(semi_in_set(works, leaders, ["person_id"]))
    counts = element_frequencies(own, "genres", by=["person_id"], out="genre")
    roles = principals.withColumnRenamed("nconst", "person_id")
    roles = roles.withColumns({
        name: F.when(F.col(name) != NULL_MARKER, F.col(name)) for name in ("category", "characters")
    })
    return {
        "genres": format_counts(counts, ["person_id"], "genre", "n", DETAILED_PEOPLE),
        "best_works": top_n_per_group(own, ["person_id"], "averageRating", BEST_WORKS, tie=["tconst"], rank="place"),
        "roles": detail_lookup(leaders, roles, "person_id", ["category", "characters"]),
    }

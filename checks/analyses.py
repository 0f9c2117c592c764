"""The analyses and views on catalog-shaped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import catalog as K
from checks.registry import as_text, query, settle
from checks.summaries import T_TEST, settle_t
from reelmill.operators.ordered import ecdf, order_values
from reelmill.operators.profile import distribution_share
from reelmill.operators.summaries import describe_column, grouped_mean_std, grouped_summary, histogram, two_sample_t
from reelmill.plans import genres as G
from reelmill.plans import ratings as A
from reelmill.plans import runtimes as R
from reelmill.plans import talent as P
from reelmill.plans.outputs import Outputs
from reelmill.plans.views import content_performance, data_quality_report

# ---- views


@query("content_performance", f"""
SELECT t.tconst, "primaryTitle", "titleType", "startYear", round("averageRating", 4) AS "averageRating",
       CAST("numVotes" AS VARCHAR) AS "numVotes", genres
FROM ({K.TITLES}) t LEFT JOIN ({K.RATINGS}) r ON t.tconst = r.tconst
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(settle(content_performance(K.titles(spark, folder), K.ratings(spark, folder))), "numVotes")


@query("data_quality_report", f"""
SELECT 'title_basics' AS table_name, count(*) AS row_count, CAST(0 AS BIGINT) AS missing_titles,
       count(*) FILTER (WHERE "titleType" = 'short') AS missing_genres FROM ({K.TITLES})
UNION ALL SELECT 'title_ratings', count(*), 0, 0 FROM ({K.RATINGS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    titles = K.titles(spark, folder)
    titles = titles.withColumn("genres", F.when(F.col("titleType") != "short", F.col("genres")))
    return data_quality_report({"title_basics": titles, "title_ratings": K.ratings(spark, folder)})


# ---- adult flag against rating


def rated(spark: SparkSession, folder: str) -> DataFrame:
    return A.rated_titles(K.document_titles(spark, folder), K.document_ratings(spark, folder))


@query("adult_vs_rating", f"""
SELECT adult_label, count("averageRating") AS count, round(avg("averageRating"), 4) AS mean,
       round(median("averageRating"), 4) AS median, round(stddev_samp("averageRating"), 4) AS std,
       min("averageRating") AS min, max("averageRating") AS max FROM ({K.RATED}) GROUP BY adult_label
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.adult_vs_rating(rated(spark, folder))["summary"])


@query("adult_vs_rating_shares", f"""
SELECT adult_label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct
FROM ({K.RATED}) GROUP BY adult_label
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.adult_vs_rating(rated(spark, folder))["shares"])


@query("adult_vs_rating_means", f"""
SELECT adult_label, round(avg("averageRating"), 4) AS mean, round(stddev_samp("averageRating"), 4) AS std
FROM ({K.RATED}) GROUP BY adult_label
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.adult_vs_rating(rated(spark, folder))["means"])


def histogram_sql(rows: str, by: str, value: str, bins: int) -> str:
    return f"""
    WITH x AS ({rows}), b AS (SELECT {by} AS k, min({value}) AS lo, (max({value}) - min({value})) / {bins} AS w FROM x GROUP BY 1),
    h AS (SELECT k, least(CAST(floor(({value} - lo) / w) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
          FROM x JOIN b ON {by} = k GROUP BY 1, 2)
    SELECT b.k AS {by}, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 4) AS bin_low,
           round(lo + (g.bin + 1) * w, 4) AS bin_high, coalesce(n, 0) AS n
    FROM b CROSS JOIN (SELECT unnest(range({bins})) AS bin) g LEFT JOIN h ON h.k = b.k AND h.bin = g.bin
    """


@query("adult_vs_rating_histogram", histogram_sql(K.RATED, "adult_label", '"averageRating"', 30))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.adult_vs_rating(rated(spark, folder))["histogram"])


def box_sql(rows: str, by: str, value: str, keep: str = "true") -> str:
    return f"""
    WITH x AS ({rows}), q AS (SELECT {by} AS k, count({value}) AS count, quantile_cont({value}, 0.25) AS q1,
         quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3 FROM x GROUP BY 1),
    r AS (SELECT k, {value} AS v, {value} BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
          FROM x JOIN q ON {by} = k)
    SELECT q.k AS {by}, count, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
           CAST(round(min(v) FILTER (WHERE inside), 4) AS DOUBLE) AS whisker_low,
           CAST(round(max(v) FILTER (WHERE inside), 4) AS DOUBLE) AS whisker_high,
           count(*) FILTER (WHERE NOT inside) AS outliers
    FROM q JOIN r ON q.k = r.k WHERE {keep} GROUP BY q.k, count, q1, median, q3
    """


@query("adult_vs_rating_boxes", box_sql(K.RATED, "adult_label", '"averageRating"'))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.adult_vs_rating(rated(spark, folder))["boxes"])


@query("adult_vs_rating_t_test", T_TEST.format(rows=K.RATED, group='"isAdult"', value='"averageRating"', a=0, b=1))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle_t(A.adult_vs_rating(rated(spark, folder))["t_test"])


# ---- one class alone

ONE_CLASS = f"SELECT * FROM ({K.RATED}) WHERE \"isAdult\" = 0"


def one_class(spark: SparkSession, folder: str) -> DataFrame:
    return rated(spark, folder).filter(F.col("isAdult") == 0)


@query("single_class_profile", f"""
SELECT rating_range, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct FROM (
  SELECT CASE WHEN "averageRating" > 0 AND "averageRating" <= 3 THEN 'Poor (1-3)'
              WHEN "averageRating" > 3 AND "averageRating" <= 5 THEN 'Fair (3-5)'
              WHEN "averageRating" > 5 AND "averageRating" <= 7 THEN 'Good (5-7)'
              WHEN "averageRating" > 7 AND "averageRating" <= 10 THEN 'Excellent (7-10)' END AS rating_range
  FROM ({ONE_CLASS})) WHERE rating_range IS NOT NULL GROUP BY rating_range
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.single_class_profile(one_class(spark, folder))["ranges"])


@query("single_class_high_low", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE "averageRating" >= 7) AS high,
       count(*) FILTER (WHERE "averageRating" < 5) AS low,
       round(count(*) FILTER (WHERE "averageRating" >= 7) * 100.0 / count(*), 4) AS high_pct,
       round(count(*) FILTER (WHERE "averageRating" < 5) * 100.0 / count(*), 4) AS low_pct FROM ({ONE_CLASS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.single_class_profile(one_class(spark, folder))["high_low"])


@query("single_class_description", f"""
SELECT count("averageRating") AS count, round(avg("averageRating"), 4) AS mean,
       round(stddev_samp("averageRating"), 4) AS std, min("averageRating") AS min,
       round(quantile_cont("averageRating", 0.25), 4) AS q1, round(quantile_cont("averageRating", 0.5), 4) AS median,
       round(quantile_cont("averageRating", 0.75), 4) AS q3, max("averageRating") AS max FROM ({ONE_CLASS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.single_class_profile(one_class(spark, folder))["description"])


@query("single_class_ecdf", f"""
SELECT DISTINCT "averageRating", count(*) OVER (PARTITION BY "averageRating") AS n,
       round(cume_dist() OVER (ORDER BY "averageRating"), 6) AS share FROM ({ONE_CLASS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(A.single_class_profile(one_class(spark, folder))["ecdf"], 6)


# ---- genres against the adult flag

GENRE_ROWS = f"""
SELECT * EXCLUDE (genres), trim(unnest(string_split(genres, ','))) AS genre FROM ({K.TITLES})
"""
GENRE_RATES = f"""
SELECT genre, count(*) AS n, CAST(sum(CAST("isAdult" AS INTEGER)) AS BIGINT) AS flagged,
       avg(CAST("isAdult" AS INTEGER)) AS share FROM ({GENRE_ROWS}) GROUP BY genre ORDER BY n DESC, genre LIMIT 15
"""


def genre_rows(spark: SparkSession, folder: str) -> DataFrame:
    return G.adult_genre_rows(K.titles(spark, folder))


@query("genre_vs_adult", f"""
SELECT genre, n, flagged, round(share, 4) AS share, round(share * 100, 4) AS pct FROM ({GENRE_RATES})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(G.genre_adult_rates(genre_rows(spark, folder)))


GENRE_TABLE = """
SELECT genre, count(*) FILTER (WHERE NOT "isAdult") AS non_adult, count(*) FILTER (WHERE "isAdult") AS adult,
       count(*) AS total FROM ({rows}) WHERE genre IN (SELECT genre FROM ({top}) ORDER BY n DESC, genre LIMIT {k}) GROUP BY genre
"""


@query("genre_vs_adult_counts", GENRE_TABLE.format(rows=GENRE_ROWS, top=GENRE_RATES, k=15))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return G.genre_adult_table(genre_rows(spark, folder))


@query("genre_vs_adult_short", GENRE_TABLE.format(rows=GENRE_ROWS, top=GENRE_RATES, k=10))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return G.genre_adult_table(genre_rows(spark, folder), G.TOP_GENRES_SHORT)


@query("genre_vs_adult_percentages", f"""
SELECT genre, round(non_adult * 100.0 / total, 4) AS non_adult, round(adult * 100.0 / total, 4) AS adult
FROM ({GENRE_TABLE.format(rows=GENRE_ROWS, top=GENRE_RATES, k=15)})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(G.genre_adult_table(genre_rows(spark, folder), normalize="row"))


@query("genre_vs_adult_most", f"""
SELECT genre, n, flagged, round(share, 4) AS share, round(share * 100, 4) AS pct FROM ({GENRE_RATES})
WHERE share > 0 ORDER BY share * 100 DESC, genre LIMIT 5
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(G.genre_vs_adult(K.titles(spark, folder))["most_adult"])


@query("genre_vs_adult_totals", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE "isAdult") AS adult, count(*) FILTER (WHERE NOT "isAdult") AS non_adult,
       round(count(*) FILTER (WHERE "isAdult") * 100.0 / count(*), 4) AS adult_pct,
       round(count(*) FILTER (WHERE NOT "isAdult") * 100.0 / count(*), 4) AS non_adult_pct FROM ({K.TITLES})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(G.genre_vs_adult(K.titles(spark, folder))["totals"])


# ---- genres against runtime

RUNTIME_STATS = f"""
SELECT genre, count("runtimeMinutes") AS count, round(avg("runtimeMinutes"), 4) AS mean, median("runtimeMinutes") AS median,
       round(stddev_samp("runtimeMinutes"), 4) AS std, CAST(min("runtimeMinutes") AS DOUBLE) AS min,
       CAST(max("runtimeMinutes") AS DOUBLE) AS max
FROM ({GENRE_ROWS}) GROUP BY genre HAVING count(*) >= 100 ORDER BY count DESC, genre LIMIT 15
"""


def ordered_runtimes(spark: SparkSession, folder: str):
    return order_values(R.runtime_genre_rows(K.titles(spark, folder)), ["genre"], ["runtimeMinutes"])


@query("genre_vs_runtime", f"SELECT * FROM ({RUNTIME_STATS})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.genre_runtime_stats(ordered_runtimes(spark, folder)))


@query("genre_vs_runtime_boxes", box_sql(
    GENRE_ROWS, "genre", '"runtimeMinutes"', f"q.k IN (SELECT genre FROM ({RUNTIME_STATS}) ORDER BY count DESC, genre LIMIT 10)"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.genre_vs_runtime(K.titles(spark, folder))["boxes"])


@query("genre_vs_runtime_variable", f"SELECT * FROM ({RUNTIME_STATS}) ORDER BY std DESC, genre LIMIT 3")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.genre_vs_runtime(K.titles(spark, folder))["most_variable"])


@query("genre_vs_runtime_overall", f"""
SELECT count("runtimeMinutes") AS count, round(avg("runtimeMinutes"), 4) AS mean, round(stddev_samp("runtimeMinutes"), 4) AS std,
       CAST(min("runtimeMinutes") AS DOUBLE) AS min, quantile_cont("runtimeMinutes", 0.25) AS q1,
       quantile_cont("runtimeMinutes", 0.5) AS median, quantile_cont("runtimeMinutes", 0.75) AS q3,
       CAST(max("runtimeMinutes") AS DOUBLE) AS max FROM ({K.TITLES})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.overall_runtime(K.titles(spark, folder)))


CATEGORY = """
CASE WHEN "runtimeMinutes" < 30 THEN 'Short (<30m)' WHEN "runtimeMinutes" < 60 THEN 'Medium (30-60m)'
     WHEN "runtimeMinutes" < 90 THEN 'Standard (60-90m)' WHEN "runtimeMinutes" < 120 THEN 'Long (90-120m)'
     ELSE 'Very Long (>120m)' END
"""


@query("runtime_categories", f"""
SELECT w.c AS runtime_category, CAST(w.p AS INTEGER) AS position, coalesce(n, 0) AS n
FROM (VALUES ('Short (<30m)', 1), ('Medium (30-60m)', 2), ('Standard (60-90m)', 3), ('Long (90-120m)', 4),
             ('Very Long (>120m)', 5)) w(c, p)
LEFT JOIN (SELECT {CATEGORY} AS c, count(*) AS n FROM ({GENRE_ROWS})
           WHERE genre IN (SELECT genre FROM ({RUNTIME_STATS})) GROUP BY 1) x ON w.c = x.c
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.runtime_categories(R.runtime_genre_rows(K.titles(spark, folder)))["counts"]


@query("runtime_categories_by_genre", f"""
SELECT genre, round(count(*) FILTER (WHERE c LIKE 'Short%') * 100.0 / count(*), 4) AS short,
       round(count(*) FILTER (WHERE c LIKE 'Medium%') * 100.0 / count(*), 4) AS medium,
       round(count(*) FILTER (WHERE c LIKE 'Standard%') * 100.0 / count(*), 4) AS standard,
       round(count(*) FILTER (WHERE c LIKE 'Long%') * 100.0 / count(*), 4) AS long,
       round(count(*) FILTER (WHERE c LIKE 'Very%') * 100.0 / count(*), 4) AS very_long
FROM (SELECT genre, {CATEGORY} AS c FROM ({GENRE_ROWS}))
WHERE genre IN (SELECT genre FROM ({RUNTIME_STATS}) ORDER BY count DESC, genre LIMIT 10) GROUP BY genre
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.runtime_categories(R.runtime_genre_rows(K.titles(spark, folder)))["percentages"])


# ---- genres against ratings and votes

RATED_GENRES = f"""
SELECT g.genre, g.tconst, r."averageRating" AS rating, r."numVotes" AS votes, log10(r."numVotes") AS log_votes
FROM ({GENRE_ROWS}) g JOIN ({K.RATINGS}) r ON g.tconst = r.tconst
WHERE r."averageRating" BETWEEN 1 AND 10 AND r."numVotes" >= 5
"""
GENRE_STATS = f"""
SELECT genre, count(rating) AS "averageRating_count", avg(rating) AS "averageRating_mean",
       median(rating) AS "averageRating_median", stddev_samp(rating) AS "averageRating_std",
       avg(votes) AS "numVotes_mean", median(votes) AS "numVotes_median", stddev_samp(votes) AS "numVotes_std",
       avg(log_votes) AS "log_numVotes_mean", stddev_samp(log_votes) AS "log_numVotes_std"
FROM ({RATED_GENRES}) GROUP BY genre HAVING count(*) >= 50 ORDER BY "averageRating_count" DESC, genre LIMIT 15
"""
STAT_NAMES = [f"{col}_{stat}" for col, stats in G.GENRE_STATS.items() for stat in stats]
DOUBLE_STATS = [name for name in STAT_NAMES if not name.endswith("_count")]
SHOWN_STATS = ", ".join(f'round("{name}", 4) AS "{name}"' for name in DOUBLE_STATS)
SHOWN = f'genre, "averageRating_count", {SHOWN_STATS}'


def genre_ratings(spark: SparkSession, folder: str) -> Outputs:
    return G.genre_rating_votes(K.titles(spark, folder), K.ratings(spark, folder))


@query("genre_rating_votes_overall", f"""
SELECT count(*) AS titles, (SELECT count(DISTINCT genre) FROM ({RATED_GENRES})) AS genres, round(avg(rating), 4) AS mean_rating,
       round(avg(votes), 4) AS mean_votes, median(votes) AS median_votes
FROM (SELECT DISTINCT tconst, rating, votes FROM ({RATED_GENRES}))
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(genre_ratings(spark, folder)["overall"])


@query("genre_rating_votes", f"SELECT {SHOWN} FROM ({GENRE_STATS})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(genre_ratings(spark, folder)["stats"])


@query("genre_rating_votes_quadrants", f"""
WITH s AS MATERIALIZED ({GENRE_STATS}), m AS (SELECT median("averageRating_mean") AS r, median("numVotes_mean") AS v FROM s)
SELECT {SHOWN}, CASE WHEN "averageRating_mean" >= r AND "numVotes_mean" >= v THEN 'High Quality & High Popularity'
            WHEN "averageRating_mean" >= r THEN 'High Quality & Low Popularity'
            WHEN "numVotes_mean" >= v THEN 'Low Quality & High Popularity'
            ELSE 'Low Quality & Low Popularity' END AS quadrant FROM s, m
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(genre_ratings(spark, folder)["quadrants"])


def ranking_query(name: str, sql: str) -> None:
    @query(f"genre_rating_votes_{name}", sql)
    def _(spark: SparkSession, folder: str) -> DataFrame:
        return settle(genre_ratings(spark, folder)[name])


CONSISTENCY = """
CASE WHEN "averageRating_std" < 1.0 THEN 'Very Consistent' WHEN "averageRating_std" < 1.2 THEN 'Moderately Consistent'
     WHEN "averageRating_std" >= 1.2 THEN 'Variable' END AS consistency
"""
ranking_query("highest_rated", f'SELECT {SHOWN} FROM ({GENRE_STATS}) s ORDER BY s."averageRating_mean" DESC, genre LIMIT 3')
ranking_query("most_voted", f'SELECT {SHOWN} FROM ({GENRE_STATS}) s ORDER BY s."numVotes_mean" DESC, genre LIMIT 3')
ranking_query("popular", f'SELECT {SHOWN} FROM ({GENRE_STATS}) s ORDER BY s."numVotes_mean" DESC, genre LIMIT 5')
ranking_query("most_consistent", f'SELECT {SHOWN} FROM ({GENRE_STATS}) s ORDER BY s."averageRating_std", genre LIMIT 3')
ranking_query("quality_leaders", f"""
SELECT {SHOWN}, {CONSISTENCY} FROM ({GENRE_STATS}) s ORDER BY s."averageRating_mean" DESC, genre LIMIT 5
""")
ranking_query("consistency_champions", f"""
SELECT {SHOWN}, {CONSISTENCY} FROM ({GENRE_STATS}) s ORDER BY s."averageRating_std", genre LIMIT 5
""")
ranking_query("hidden_gems", f"""
WITH s AS MATERIALIZED ({GENRE_STATS}), m AS (SELECT avg("averageRating_mean") AS r, avg("numVotes_mean") AS v FROM s)
SELECT {SHOWN}, 'hidden_gem' AS segment FROM s, m WHERE s."averageRating_mean" > r AND s."numVotes_mean" < v
ORDER BY s."averageRating_mean" DESC, genre LIMIT 3
""")
ranking_query("mass_appeal", f"""
WITH s AS MATERIALIZED ({GENRE_STATS}), m AS (SELECT avg("averageRating_mean") AS r, avg("numVotes_mean") AS v FROM s)
SELECT {SHOWN}, 'mass_appeal' AS segment FROM s, m
WHERE s."numVotes_mean" > v AND s."averageRating_mean" BETWEEN r - 0.2 AND r + 0.2
ORDER BY s."numVotes_mean" DESC, genre LIMIT 3
""")


@query("genre_rating_votes_histograms", histogram_sql(
    f"SELECT * FROM ({RATED_GENRES}) WHERE genre IN (SELECT genre FROM ({GENRE_STATS}) ORDER BY \"averageRating_count\" DESC, genre LIMIT 6)",
    "genre", "rating", 20))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(genre_ratings(spark, folder)["ratings"])


@query("genre_rating_votes_sample", f"""
SELECT genre, tconst, round(rating, 4) AS "averageRating" FROM ({RATED_GENRES}) WHERE genre IN (SELECT genre FROM ({GENRE_STATS}))
ORDER BY md5(tconst || ':' || genre || ':{G.SCATTER_SEED}'), tconst, genre LIMIT {G.SCATTER_SIZE}
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(genre_ratings(spark, folder)["sample"].select("genre", "tconst", "averageRating"))


# ---- extreme runtimes, runtimes by group

TITLED = f"""
SELECT t.tconst, "titleType", "isAdult", "startYear", CAST("runtimeMinutes" AS DOUBLE) AS minutes, title, "averageRating"
FROM ({K.TITLES}) t JOIN ({K.RATINGS}) r ON t.tconst = r.tconst LEFT JOIN ({K.AKAS}) a ON t.tconst = a.tconst
WHERE "runtimeMinutes" BETWEEN 1 AND 1000 AND "averageRating" BETWEEN 1 AND 10 AND "numVotes" >= 5
"""


def titled(spark: SparkSession, folder: str) -> DataFrame:
    return R.titled_runtimes(K.titles(spark, folder), K.ratings(spark, folder), K.akas(spark, folder))


KINDS = f"""
SELECT *, CASE WHEN "titleType" = 'movie' THEN 'movie' WHEN "titleType" = 'tvSeries' AND "isAdult" THEN 'series_adult'
               WHEN "titleType" = 'tvSeries' THEN 'series_non_adult' END AS kind FROM ({TITLED})
"""


@query("extreme_runtimes", f"""
SELECT 'longest' AS extreme, kind, tconst, title, minutes FROM ({KINDS}) WHERE kind IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY minutes DESC, tconst, title NULLS FIRST) = 1
UNION ALL SELECT 'shortest', kind, tconst, title, minutes FROM ({KINDS}) WHERE kind IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY minutes, tconst, title NULLS FIRST) = 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = R.extreme_runtimes(titled(spark, folder)).withColumnRenamed("runtimeMinutes", "minutes")
    return found.select("extreme", "kind", "tconst", "title", "minutes")


@query("runtime_by_group", f"""
SELECT "titleType", CASE WHEN "isAdult" THEN 'Adult' ELSE 'Non-Adult' END AS adult_label, round(avg(minutes), 4) AS mean
FROM ({TITLED}) WHERE "titleType" IN ('movie', 'tvSeries') GROUP BY 1, 2
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.runtime_by_group(titled(spark, folder))["means"])


@query("runtime_by_group_decades", f"""
SELECT CAST("startYear" // 10 * 10 AS INTEGER) AS decade, round(avg(minutes), 4) AS mean FROM ({TITLED})
WHERE "titleType" = 'movie' AND "startYear" // 10 * 10 >= 1950 GROUP BY 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.runtime_by_group(titled(spark, folder))["decades"])


@query("runtime_by_group_histogram", histogram_sql(
    f"SELECT * FROM ({TITLED}) WHERE \"titleType\" IN ('movie', 'tvSeries')", '"titleType"', "minutes", 50))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.runtime_by_group(titled(spark, folder))["histogram"])


@query("runtime_by_group_sample", f"""
SELECT tconst, round(minutes, 4) AS "runtimeMinutes" FROM ({TITLED}) WHERE "titleType" = 'movie'
ORDER BY md5(tconst || ':{R.SCATTER_SEED}'), tconst LIMIT {R.SCATTER_SIZE}
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(R.runtime_by_group(titled(spark, folder))["movie_sample"].select("tconst", "runtimeMinutes"))


# ---- directors and writers

SCORED = """
SELECT w.*, p.category, p.characters, rating * log10(votes + 1) AS score FROM ({works}) w
LEFT JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS tconst, CAST(l_suppkey AS VARCHAR) AS nconst,
                  CASE WHEN l_returnflag = 'A' THEN '\\N' ELSE l_returnflag END AS category, l_linestatus AS characters
           FROM lineitem) p
  ON w.tconst = p.tconst AND w.person_id = p.nconst
"""
WEIGHTED = """
SELECT person_id, count(rating) AS n, avg(rating) AS rating_mean, stddev_samp(rating) AS rating_std,
       avg(votes) AS votes_mean, sum(votes) AS votes_sum, avg(score) AS score_mean, avg(original) AS original_mean
FROM ({scored}) GROUP BY person_id HAVING count(rating) >= {least} AND avg(votes) >= 100
ORDER BY score_mean DESC, person_id LIMIT 10
"""
SHOWN_WEIGHTED = """
SELECT CAST(row_number() OVER (ORDER BY score_mean DESC, person_id) AS INTEGER) AS rank, person_id, n,
       round(rating_mean, 4) AS rating_mean, round(rating_std, 4) AS rating_std, round(votes_mean, 4) AS votes_mean,
       CAST(votes_sum AS BIGINT) AS votes_sum, round(score_mean, 4) AS score_mean, round(original_mean, 4) AS original_mean
FROM ({weighted})
"""
NAMES = {
    "averageRating_count": "n", "averageRating_mean": "rating_mean", "averageRating_std": "rating_std",
    "numVotes_mean": "votes_mean", "numVotes_sum": "votes_sum", "weighted_score_mean": "score_mean",
    "isOriginal_mean": "original_mean",
}


def works(spark: SparkSession, folder: str, role: str) -> DataFrame:
    return P.weighted_works(
        K.order_titles(spark, folder), K.order_crew(spark, folder), K.order_ratings(spark, folder),
        K.order_akas(spark, folder), K.order_principals(spark, folder), role,
    )


def shown(stats: DataFrame) -> DataFrame:
    return settle(stats.withColumnsRenamed(NAMES).withColumn("votes_sum", F.col("votes_sum").cast("long")))


DIRECTOR_WORKS = K.WORKS.format(person="l_suppkey")
DIRECTORS = WEIGHTED.format(scored=SCORED.format(works=DIRECTOR_WORKS), least=3)


@query("talent_weighted", SHOWN_WEIGHTED.format(weighted=DIRECTORS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shown(P.talent_weighted(works(spark, folder, "directors")))


@query("talent_weighted_writers", SHOWN_WEIGHTED.format(
    weighted=WEIGHTED.format(scored=SCORED.format(works=K.WORKS.format(person="l_partkey")), least=3)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shown(P.talent_weighted(works(spark, folder, "writers")))


@query("talent_weighted_distinct", SHOWN_WEIGHTED.format(weighted=WEIGHTED.format(
    scored=f"SELECT DISTINCT person_id, tconst, rating, votes, original, rating * log10(votes + 1) AS score FROM ({DIRECTOR_WORKS})",
    least=3)))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shown(P.talent_weighted(works(spark, folder, "directors"), count_distinct_titles=True))


LEADER = f"""
SELECT * FROM ({SCORED.format(works=DIRECTOR_WORKS)}) WHERE person_id IN (
  SELECT person_id FROM ({DIRECTORS}) ORDER BY score_mean DESC, person_id LIMIT 1)
"""


@query("talent_weighted_leader", f"""
WITH own AS ({LEADER})
SELECT 'genre' AS kind, genre AS item, n
FROM (SELECT genre, count(*) AS n FROM (SELECT trim(unnest(string_split(genres, ','))) AS genre FROM own)
  GROUP BY 1 ORDER BY n DESC, genre LIMIT 5)
UNION ALL SELECT 'category', category, n FROM (SELECT category, count(*) AS n FROM own WHERE category IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, category LIMIT 5)
UNION ALL SELECT 'characters', characters, 1 FROM (SELECT DISTINCT characters FROM own WHERE characters IS NOT NULL
  AND characters <> '\\N' ORDER BY characters LIMIT 5)
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    own = works(spark, folder, "directors")
    details = P.leader_details(own, P.talent_weighted(own))
    parts = [
        details["genres"].select(F.lit("genre").alias("kind"), F.col("genre").alias("item"), "n"),
        details["categories"].select(F.lit("category").alias("kind"), F.col("category").alias("item"), "n"),
        details["characters"].select(
            F.lit("characters").alias("kind"), F.col("characters").alias("item"), F.lit(1).cast("long").alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("talent_weighted_best_works", f"""
SELECT tconst, genres, round(rating, 4) AS rating, votes, original
FROM (SELECT DISTINCT tconst, genres, rating, votes, original FROM ({LEADER}))
ORDER BY rating DESC, tconst LIMIT 5
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    own = works(spark, folder, "directors")
    best = P.leader_details(own, P.talent_weighted(own))["best_works"].select(
        "tconst", "genres", "averageRating", "numVotes", "isOriginal")
    names = {"averageRating": "rating", "numVotes": "votes", "isOriginal": "original"}
    return settle(best.withColumnsRenamed(names).withColumn("votes", F.col("votes").cast("long")))


RATED_WORKS = "SELECT * FROM ({works}) WHERE rating BETWEEN 1 AND 10 AND votes >= 10"
PERSON_STATS = """
SELECT person_id, count(rating) AS n, avg(rating) AS rating_mean, stddev_samp(rating) AS rating_std,
       CAST(sum(votes) AS BIGINT) AS votes_sum, avg(votes) AS votes_mean, avg(original) AS original_mean
FROM ({works}) GROUP BY person_id HAVING count(rating) >= 3
"""
DIRECTOR_RATED = RATED_WORKS.format(works=DIRECTOR_WORKS)
DIRECTOR_STATS = PERSON_STATS.format(works=DIRECTOR_RATED)
WRITER_STATS = PERSON_STATS.format(works=RATED_WORKS.format(works=K.WORKS.format(person="l_partkey")))
SHOWN_PERSON = """person_id, n, round(rating_mean, 4) AS rating_mean, round(rating_std, 4) AS rating_std, votes_sum,
       round(votes_mean, 4) AS votes_mean, round(original_mean, 4) AS original_mean"""


def rated_works(spark: SparkSession, folder: str, role: str) -> DataFrame:
    return P.rated_works(
        K.order_ratings(spark, folder), K.order_titles(spark, folder), K.order_crew(spark, folder),
        K.order_akas(spark, folder), role,
    )


def by_rating_sql(stats: str) -> str:
    return f"""
    SELECT {SHOWN_PERSON}, CAST(row_number() OVER (ORDER BY s.rating_mean DESC, person_id) AS INTEGER) AS rank,
           coalesce(s_name, 'Unknown') AS name
    FROM ({stats} ORDER BY avg(rating) DESC, person_id LIMIT 10) s
    LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 3000) ON person_id = CAST(s_suppkey AS VARCHAR)
    """


@query("talent_by_rating", by_rating_sql(DIRECTOR_STATS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    stats = P.person_stats(rated_works(spark, folder, "directors"))
    return shown(P.talent_by_rating(stats, K.names(spark, folder)))


@query("talent_by_rating_writers", by_rating_sql(WRITER_STATS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    stats = P.person_stats(rated_works(spark, folder, "writers"))
    return shown(P.talent_by_rating(stats, K.names(spark, folder)))


@query("talent_by_votes", f"SELECT {SHOWN_PERSON} FROM ({DIRECTOR_STATS}) s ORDER BY s.votes_sum DESC, person_id LIMIT 10")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shown(P.talent_by_votes(P.person_stats(rated_works(spark, folder, "directors"))))


@query("talent_by_consistency", f"SELECT {SHOWN_PERSON} FROM ({DIRECTOR_STATS}) s ORDER BY s.rating_std, person_id LIMIT 10")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shown(P.talent_by_consistency(P.person_stats(rated_works(spark, folder, "directors"))))


LEADERS = f"SELECT person_id FROM ({DIRECTOR_STATS}) ORDER BY rating_mean DESC, person_id LIMIT 3"


@query("talent_details", f"""
WITH own AS (SELECT * FROM ({DIRECTOR_RATED}) WHERE person_id IN ({LEADERS})),
g AS (SELECT person_id, genre, count(*) AS n
      FROM (SELECT person_id, trim(unnest(string_split(genres, ','))) AS genre FROM own) GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY n DESC, genre) <= 3)
SELECT g.person_id, g.summary, r.category, r.characters
FROM (SELECT person_id, string_agg(genre || '(' || n || ')', ', ' ORDER BY n DESC, genre) AS summary FROM g GROUP BY 1) g
LEFT JOIN (SELECT CAST(l_suppkey AS VARCHAR) AS person_id,
                  array_to_string(list_sort(list(DISTINCT l_returnflag) FILTER (WHERE l_returnflag <> 'A')), '|') AS category,
                  array_to_string(list_sort(list(DISTINCT l_linestatus)), '|') AS characters
           FROM lineitem GROUP BY 1) r ON g.person_id = r.person_id
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    own = rated_works(spark, folder, "directors")
    ranked = P.talent_by_rating(P.person_stats(own), K.names(spark, folder))
    details = P.talent_details(own, ranked, K.order_principals(spark, folder))
    return settle(details["genres"].join(details["roles"], "person_id", "left"))


@query("talent_details_works", f"""
SELECT person_id, tconst, genres, round(rating, 4) AS rating, votes, original,
       CAST(row_number() OVER (PARTITION BY person_id ORDER BY w.rating DESC, tconst) AS INTEGER) AS place
FROM (SELECT * FROM ({DIRECTOR_RATED}) WHERE person_id IN ({LEADERS})) w QUALIFY place <= 3
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    own = rated_works(spark, folder, "directors")
    ranked = P.talent_by_rating(P.person_stats(own), K.names(spark, folder))
    best = P.talent_details(own, ranked, K.order_principals(spark, folder))["best_works"]
    names = {"averageRating": "rating", "numVotes": "votes", "isOriginal": "original"}
    return settle(best.withColumnsRenamed(names).withColumn("votes", F.col("votes").cast("long")))



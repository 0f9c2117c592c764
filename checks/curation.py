"""The seven curation jobs on dumps written from the given tables.

Each dump is written as delimited text, read back, typed, exploded and checked; the SQL side derives the
same checks from the tables themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import catalog as K
from checks.registry import as_text, query, settle, table
from reelmill.functions.columns import NULL_MARKER
from reelmill.plans import catalog as C
from reelmill.schemas import KEYS, RAW
from reelmill.session import fresh_path


def dump(raw: DataFrame, name: str) -> str:
    """Write a frame as a raw dump: header, tabs, null markers, no quoting."""
    path = fresh_path(raw.sparkSession, name)
    texts = raw.select(*[F.col(c).cast("string").alias(c) for c in RAW[name].names])
    texts.write.csv(path, sep="\t", header=True, nullValue=NULL_MARKER, emptyValue="", quote="", escape="\u0001")
    return path


def curated(raw: DataFrame, name: str, latest_year: int = C.LATEST_YEAR) -> C.Curated:
    return C.curate_file(raw.sparkSession, name, dump(raw, name), latest_year)


def checks_sql(
    name: str, rows: str, ranges: list[str] = (), rules: dict[str, str] | None = None,
    children: dict[str, str] | None = None,
) -> str:
    """The check report in SQL over ``rows``, which has the typed columns of the curated table."""
    keys = KEYS[name]
    parts = [("rows", "", "count(*)")]
    parts += [("nulls", c, f'count(*) FILTER (WHERE "{c}" IS NULL)') for c in RAW[name].names]
    for c in ranges:
        parts += [("min", c, f'min("{c}")'), ("max", c, f'max("{c}")')]
    parts += [("violations", rule, f"count(*) FILTER (WHERE {test})") for rule, test in (rules or {}).items()]
    key = ", ".join(f'"{k}"' for k in keys)
    parts.append(("duplicates", "+".join(keys), f"count(*) - count(DISTINCT ({key}))"))
    for suffix, column in (children or {}).items():
        size = f"""coalesce(sum(CASE WHEN "{column}" <> '' THEN len(string_split("{column}", ',')) END), 0)"""
        parts.append(("child_rows", suffix, size))
    selects = [
        f"SELECT '{name}' AS table_name, '{check}' AS check_name, '{subject}' AS subject, CAST({value} AS VARCHAR) AS value FROM t"
        for check, subject, value in parts
    ]
    return f"WITH t AS ({rows}) " + " UNION ALL ".join(selects)


def report(job: C.Curated) -> DataFrame:
    """All checks, as publishing the job finds them."""
    seen = job.publish(fresh_path(job.main.sparkSession, "published"))
    rows = [(job.table, *name.split("|"), None if value is None else str(value)) for name, value in seen.items()]
    return job.main.sparkSession.createDataFrame(rows, "table_name string, check_name string, subject string, value string")


# ---- titles from parts

BASICS = """
SELECT CAST(p_partkey AS VARCHAR) AS tconst, p_type AS "titleType", '"' || p_name AS "primaryTitle",
       CASE WHEN p_size > 10 THEN p_name END AS "originalTitle",
       CASE p_brand WHEN 'Brand#1' THEN true WHEN 'Brand#2' THEN NULL ELSE false END AS "isAdult",
       CAST(1980 + p_size AS INTEGER) AS "startYear", CAST(CASE WHEN p_size > 30 THEN 1990 + p_size END AS INTEGER) AS "endYear",
       CASE WHEN p_type <> 'PROMO' THEN p_size - 3 END AS "runtimeMinutes",
       CASE WHEN p_type <> 'LARGE' THEN replace(p_name, ' ', ',') END AS genres
FROM part
"""


def raw_basics(spark: SparkSession, folder: str) -> DataFrame:
    col, part = F.col, table(spark, folder, "part")
    return part.select(
        col("p_partkey").alias("tconst"),
        col("p_type").alias("titleType"),
        F.concat(F.lit('"'), "p_name").alias("primaryTitle"),
        F.when(col("p_size") > 10, col("p_name")).alias("originalTitle"),
        F.when(col("p_brand") == "Brand#1", "1").when(col("p_brand") == "Brand#2", "2").otherwise("0").alias("isAdult"),
        (col("p_size") + 1980).alias("startYear"),
        F.when(col("p_size") > 30, col("p_size") + 1990).alias("endYear"),
        F.when(col("p_type") != "PROMO", (col("p_size") - 3).cast("string")).otherwise("long").alias("runtimeMinutes"),
        F.when(col("p_type") != "LARGE", F.regexp_replace("p_name", " ", ",")).alias("genres"),
    )


@query("curate_title_basics", checks_sql(
    "title_basics", BASICS, ["startYear", "endYear"],
    {"future_start_year": '"startYear" > 2025', "future_end_year": '"endYear" > 2025',
     "negative_runtime": '"runtimeMinutes" < 0'}, {"genres": "genres"}))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return report(curated(raw_basics(spark, folder), "title_basics"))


@query("curate_title_basics_main", f"""
SELECT * REPLACE (CAST("isAdult" AS VARCHAR) AS "isAdult", CAST("endYear" AS VARCHAR) AS "endYear",
                  CAST("runtimeMinutes" AS VARCHAR) AS "runtimeMinutes") FROM ({BASICS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    main = curated(raw_basics(spark, folder), "title_basics").main
    return as_text(main, "isAdult", "endYear", "runtimeMinutes")


@query("curate_title_basics_arrays", f"""
SELECT tconst, array_to_string(list_sort(string_split(genres, ',')), '|') AS genres_array FROM ({BASICS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(curated(raw_basics(spark, folder), "title_basics").with_arrays().select("tconst", "genres_array"))


@query("curate_title_basics_published", f"""
SELECT 'titles' AS source, CAST(count(*) AS BIGINT) AS n, count(*) AS checked FROM ({BASICS})
UNION ALL SELECT 'genres', CAST(sum(len(string_split(genres, ','))) AS BIGINT), count(*) FILTER (WHERE genres IS NULL)
FROM ({BASICS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "published")
    seen = curated(raw_basics(spark, folder), "title_basics").publish(target)
    titles = spark.read.parquet(target).agg(
        F.lit("titles").alias("source"), F.count("*").alias("n"), F.lit(seen["rows|"]).cast("long").alias("checked"))
    genres = spark.read.parquet(f"{target}_genres").agg(
        F.lit("genres").alias("source"), F.count("*").alias("n"), F.lit(seen["nulls|genres"]).cast("long").alias("checked"))
    return titles.unionByName(genres)


# ---- ratings from line items

TITLE_RATINGS = """
SELECT CAST(l_orderkey AS VARCHAR) AS tconst, l_quantity / 4 AS "averageRating",
       CAST(l_linenumber - 2 AS INTEGER) AS "numVotes" FROM lineitem
"""


def raw_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem", "l_orderkey", "l_quantity", "l_linenumber").select(
        F.col("l_orderkey").alias("tconst"), (F.col("l_quantity") / 4).alias("averageRating"),
        (F.col("l_linenumber") - 2).alias("numVotes"),
    )


@query("curate_title_ratings", checks_sql("title_ratings", TITLE_RATINGS, rules={
    "rating_out_of_range": '"averageRating" < 0 OR "averageRating" > 10', "negative_votes": '"numVotes" < 0'}))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return report(curated(raw_ratings(spark, folder), "title_ratings"))


# ---- crew from line items

CREW = """
SELECT CAST(o_orderkey AS VARCHAR) AS tconst, directors, writers FROM orders LEFT JOIN (
  SELECT l_orderkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',') AS directors,
         string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',') AS writers FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
"""


def raw_crew(spark: SparkSession, folder: str) -> DataFrame:
    crew = K.order_crew(spark, folder)
    return crew.withColumns({c: F.regexp_replace(c, " ,", ",") for c in ("directors", "writers")})


@query("curate_title_crew", checks_sql("title_crew", CREW, children={"directors": "directors", "writers": "writers"}))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return report(curated(raw_crew(spark, folder), "title_crew"))


@query("curate_title_crew_arrays", """
SELECT CAST(o_orderkey AS VARCHAR) AS tconst, coalesce(array_to_string(d, '|'), '') AS directors_array,
       coalesce(array_to_string(w, '|'), '') AS writers_array FROM orders LEFT JOIN (
  SELECT l_orderkey, list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR))) AS d,
         list_sort(list(DISTINCT CAST(l_partkey AS VARCHAR))) AS w FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    arrays = curated(raw_crew(spark, folder), "title_crew").with_arrays()
    return settle(arrays.select("tconst", "directors_array", "writers_array"))


# ---- episodes from line items

EPISODE = """
SELECT l_orderkey || '_' || l_linenumber AS tconst, CAST(l_orderkey AS VARCHAR) AS "parentTconst",
       CASE WHEN l_returnflag <> 'N' THEN l_linenumber - 2 END AS "seasonNumber",
       CAST(l_quantity - 5 AS INTEGER) AS "episodeNumber" FROM lineitem
"""


def raw_episodes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("tconst"),
        F.col("l_orderkey").alias("parentTconst"),
        F.when(F.col("l_returnflag") != "N", (F.col("l_linenumber") - 2).cast("string")).otherwise("x").alias("seasonNumber"),
        (F.col("l_quantity") - 5).alias("episodeNumber"),
    )


@query("curate_title_episode", checks_sql("title_episode", EPISODE, rules={
    "negative_season": '"seasonNumber" < 0', "negative_episode": '"episodeNumber" < 0'}))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return report(curated(raw_episodes(spark, folder), "title_episode"))


# ---- principals from events

PRINCIPALS = """
SELECT CAST(user_id AS VARCHAR) AS tconst, CAST(event_id AS INTEGER) AS ordering, CAST(event_id AS VARCHAR) AS nconst,
       event_type AS category, CASE WHEN event_type = 'view' THEN 'seen' END AS job,
       CASE WHEN event_type <> 'error' THEN replace(props, '"', '') END AS characters FROM events
"""


def raw_principals(spark: SparkSession, folder: str) -> DataFrame:
    col, events = F.col, table(spark, folder, "events", "event_id", "user_id", "event_type", "props")
    return events.select(
        col("user_id").alias("tconst"), col("event_id").alias("ordering"), col("event_id").alias("nconst"),
        col("event_type").alias("category"), F.when(col("event_type") == "view", "seen").alias("job"),
        F.when(col("event_type") != "error", F.concat(F.lit("["), "props", F.lit("]"))).alias("characters"),
    )


@query("curate_title_principals", checks_sql("title_principals", PRINCIPALS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return report(curated(raw_principals(spark, folder), "title_principals"))


@query("curate_title_principals_main", PRINCIPALS)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return curated(raw_principals(spark, folder), "title_principals").main


@query("curate_title_principals_categories", "SELECT event_type AS category, count(*) AS n FROM events GROUP BY 1")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return curated(raw_principals(spark, folder), "title_principals").distributions()["category"]


# ---- alternative titles from customers

AKAS = """
SELECT CAST(c_custkey AS VARCHAR) AS "titleId", c_nationkey AS ordering, c_name AS title, n_name AS region,
       CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) END AS language,
       CASE WHEN c_acctbal > 1000 THEN 'alternative,' || lower(c_mktsegment) END AS types,
       CASE WHEN c_acctbal < 5000 THEN replace(lower(c_name), '#', ',') END AS attributes,
       CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'MACHINERY' THEN false END AS "isOriginalTitle"
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def raw_akas(spark: SparkSession, folder: str) -> DataFrame:
    col = F.col
    nation = table(spark, folder, "nation").select(col("n_nationkey").alias("c_nationkey"), "n_name")
    segment = F.lower("c_mktsegment")
    return table(spark, folder, "customer").join(nation, "c_nationkey").select(
        col("c_custkey").alias("titleId"), col("c_nationkey").alias("ordering"), col("c_name").alias("title"),
        col("n_name").alias("region"), F.when(col("c_acctbal") > 0, segment).alias("language"),
        F.when(col("c_acctbal") > 1000, F.concat(F.lit("alternative,"), segment)).alias("types"),
        F.when(col("c_acctbal") < 5000, F.regexp_replace(F.lower("c_name"), "#", ",")).alias("attributes"),
        F.when(col("c_mktsegment") == "BUILDING", "1").when(col("c_mktsegment") == "MACHINERY", "0").otherwise("?")
        .alias("isOriginalTitle"),
    )


@query("curate_title_akas", checks_sql("title_akas", AKAS, children={"types": "types", "attributes": "attributes"}))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return report(curated(raw_akas(spark, folder), "title_akas"))


@query("curate_title_akas_regions", f"SELECT region, count(*) AS n FROM ({AKAS}) GROUP BY 1 ORDER BY n DESC, region LIMIT 10")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return curated(raw_akas(spark, folder), "title_akas").distributions()["region"]


@query("curate_title_akas_arrays", f"""
SELECT "titleId", CAST(ordering AS INTEGER) AS ordering,
       coalesce(array_to_string(list_sort(string_split(types, ',')), '|'), '') AS types_array,
       coalesce(array_to_string(list_sort(string_split(attributes, ',')), '|'), '') AS attributes_array FROM ({AKAS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    arrays = curated(raw_akas(spark, folder), "title_akas").with_arrays()
    return settle(arrays.select("titleId", "ordering", "types_array", "attributes_array"))


# ---- people from customers

PEOPLE = """
SELECT CAST(c_custkey AS VARCHAR) AS nconst, c_name AS "primaryName", CAST(1900 + c_nationkey * 3 AS INTEGER) AS "birthYear",
       CAST(CASE WHEN c_acctbal > 0 THEN 1900 + floor(c_acctbal / 100) END AS INTEGER) AS "deathYear",
       lower(c_mktsegment) || ',actor' AS "primaryProfession",
       CASE WHEN c_acctbal < 9000 THEN 'tt1,tt2,tt1' END AS "knownForTitles" FROM customer
"""


def raw_names(spark: SparkSession, folder: str) -> DataFrame:
    col = F.col
    return table(spark, folder, "customer").select(
        col("c_custkey").alias("nconst"), col("c_name").alias("primaryName"),
        (col("c_nationkey") * 3 + 1900).alias("birthYear"),
        F.when(col("c_acctbal") > 0, F.floor(col("c_acctbal") / 100) + 1900).alias("deathYear"),
        F.concat(F.lower("c_mktsegment"), F.lit(",actor")).alias("primaryProfession"),
        F.when(col("c_acctbal") < 9000, "tt1,tt2,tt1").alias("knownForTitles"),
    )


@query("curate_name_basics", checks_sql(
    "name_basics", PEOPLE, ["birthYear", "deathYear"], {"death_before_birth": '"deathYear" < "birthYear"'},
    {"professions": "primaryProfession", "known_titles": "knownForTitles"}))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return report(curated(raw_names(spark, folder), "name_basics"))


@query("curate_name_basics_arrays", f"""
SELECT nconst, array_to_string(list_sort(string_split("primaryProfession", ',')), '|') AS professions_array,
       CASE WHEN "knownForTitles" IS NULL THEN '' ELSE 'tt1|tt2' END AS known_titles_array FROM ({PEOPLE})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    arrays = curated(raw_names(spark, folder), "name_basics").with_arrays()
    return settle(arrays.select("nconst", "professions_array", "known_titles_array"))


# ---- what publishing writes: each main table, child table and distribution, read back


def published_sql(rows: str, children: dict[str, str] | None = None, distributions: dict[str, int | None] | None = None) -> str:
    parts = ["SELECT 'main' AS part, count(*) AS n, CAST(NULL AS VARCHAR) AS counted FROM t"]
    for suffix, column in (children or {}).items():
        size = f"""CASE WHEN "{column}" <> '' THEN len(string_split("{column}", ',')) END"""
        parts.append(f"SELECT '{suffix}', CAST(coalesce(sum({size}), 0) AS BIGINT), NULL FROM t")
    for column, n in (distributions or {}).items():
        cut = f"LIMIT {n}" if n else ""
        parts.append(f"""SELECT 'by_{column}', count(*), CAST(CAST(sum(n) AS BIGINT) AS VARCHAR) FROM (
            SELECT "{column}", count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, "{column}" NULLS LAST {cut})""")
    return f"WITH t AS ({rows}) " + " UNION ALL ".join(parts)


def published_query(name: str, rows: str, raw, children: dict[str, str] | None = None) -> None:
    distributions = C.DISTRIBUTIONS.get(name, {})

    @query(f"curate_{name}_published", published_sql(rows, children, distributions))
    def _(spark: SparkSession, folder: str) -> DataFrame:
        target = fresh_path(spark, "published")
        curated(raw(spark, folder), name).publish(target)
        nothing = F.lit(None).cast("string").alias("counted")
        tables = {"main": target, **{suffix: f"{target}_{suffix}" for suffix in children or {}}}
        found = [spark.read.parquet(path).agg(F.lit(part).alias("part"), F.count("*").alias("n"), nothing) for part, path in tables.items()]
        found += [spark.read.parquet(f"{target}_by_{col}").agg(
            F.lit(f"by_{col}").alias("part"), F.count("*").alias("n"), F.sum("n").cast("string").alias("counted")) for col in distributions]
        return reduce(DataFrame.unionByName, found)


published_query("title_ratings", TITLE_RATINGS, raw_ratings)
published_query("title_crew", CREW, raw_crew, {"directors": "directors", "writers": "writers"})
published_query("title_episode", EPISODE, raw_episodes)
published_query("title_principals", PRINCIPALS, raw_principals)
published_query("title_akas", AKAS, raw_akas, {"types": "types", "attributes": "attributes"})
published_query("name_basics", PEOPLE, raw_names, {"professions": "primaryProfession", "known_titles": "knownForTitles"})


@query("curate_title_basics_checks", checks_sql(
    "title_basics", BASICS, ["startYear", "endYear"], {
        "future_start_year": '"startYear" > 2025', "future_end_year": '"endYear" > 2025', "negative_runtime": '"runtimeMinutes" < 0'},
    {"genres": "genres"}))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The checks without publishing."""
    return as_text(curated(raw_basics(spark, folder), "title_basics").checks(), "value")

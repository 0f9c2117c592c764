"""The given tables in the shape of the media catalog, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from reelmill.operators.lists import attach_list

# Parts as titles: words of the name are genres, size is runtime, brand number is the adult flag.
TITLES = """
SELECT CAST(p_partkey AS VARCHAR) AS tconst,
       CASE WHEN p_type IN ('STANDARD', 'MEDIUM', 'LARGE') THEN 'movie' WHEN p_type IN ('SMALL', 'PROMO') THEN 'tvSeries'
            ELSE 'short' END AS "titleType",
       p_name AS "primaryTitle", CAST(substr(p_brand, 7) AS INTEGER) <= 5 AS "isAdult", 1900 + p_size * 2 AS "startYear",
       p_size * 4 AS "runtimeMinutes", replace(p_name, ' ', ' , ') AS genres
FROM part
"""


def titles(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part", "p_partkey", "p_type", "p_name", "p_brand", "p_size")
    kind = (
        F.when(F.col("p_type").isin("STANDARD", "MEDIUM", "LARGE"), "movie")
        .when(F.col("p_type").isin("SMALL", "PROMO"), "tvSeries")
        .otherwise("short")
    )
    return part.select(
        F.col("p_partkey").cast("string").alias("tconst"),
        kind.alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        (F.expr("substring(p_brand, 7)").cast("int") <= 5).alias("isAdult"),
        (F.col("p_size") * 2 + 1900).alias("startYear"),
        F.lit(None).cast("int").alias("endYear"),
        (F.col("p_size") * 4).alias("runtimeMinutes"),
        F.regexp_replace("p_name", " ", " , ").alias("genres"),
    )


# Sold quantities as ratings and votes of parts.
RATINGS = """
SELECT CAST(l_partkey AS VARCHAR) AS tconst, avg(l_quantity) / 5 AS "averageRating",
       CAST(sum(l_quantity) AS BIGINT) AS "numVotes"
FROM lineitem GROUP BY l_partkey
"""


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_partkey", "l_quantity").groupBy("l_partkey").agg(
        (F.avg("l_quantity") / 5).alias("averageRating"), F.sum("l_quantity").cast("long").alias("numVotes")
    )
    return lines.select(F.col("l_partkey").cast("string").alias("tconst"), "averageRating", "numVotes")


# Original titles: one for dear parts, a second one for the biggest of them.
AKAS = """
SELECT CAST(p_partkey AS VARCHAR) AS tconst, 'First ' || p_name AS title FROM part WHERE p_retailprice > 950
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'Second ' || p_name FROM part WHERE p_retailprice > 950 AND p_size >= 45
"""


def akas(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part", "p_partkey", "p_name", "p_size", "p_retailprice")

    def named(word: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("p_partkey").cast("string").alias("titleId"),
            F.concat(F.lit(word), "p_name").alias("title"),
            (F.col("p_retailprice") > 950).alias("isOriginalTitle"),
        )

    return named("First ", part).unionByName(named("Second ", part.filter(F.col("p_size") >= 45)))


# Documents as titles of two classes, their length in thousands as rating.
RATED = """
SELECT CAST(d.doc_id AS VARCHAR) AS tconst, toxic AS "isAdult", n_chars / 1000 AS "averageRating",
       CASE toxic WHEN 0 THEN 'Non-Adult' WHEN 1 THEN 'Adult' END AS adult_label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def document_titles(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    return labels.select(F.col("doc_id").cast("string").alias("tconst"), (F.col("toxic") == 1).alias("isAdult"))


def document_ratings(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "n_chars")
    return documents.select(
        F.col("doc_id").cast("string").alias("tconst"), (F.col("n_chars") / 1000).alias("averageRating")
    )


# Orders as titles, suppliers as directors and parts as writers of the orders they are in.
WORKS = """
SELECT t.*, w.person_id, coalesce(o.original, 0) AS original
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS tconst,
             replace(lower(substr(o_orderpriority, 3)), ' ', ', ') || ',' || o_orderstatus AS genres,
             o_totalprice / 50000 AS rating, CAST(floor(o_totalprice / 1000) AS BIGINT) AS votes FROM orders) t
JOIN (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS tconst, CAST({person} AS VARCHAR) AS person_id FROM lineitem) w
  ON t.tconst = w.tconst
LEFT JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS tconst, 1 AS original FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1 FROM orders
           WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') o ON t.tconst = o.tconst
"""


def order_titles(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    words = F.regexp_replace(F.lower(F.expr("substring(o_orderpriority, 3)")), " ", ", ")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("tconst"),
        F.concat(words, F.lit(","), F.col("o_orderstatus")).alias("genres"),
    )


def order_ratings(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("tconst"),
        (F.col("o_totalprice") / 50000).alias("averageRating"),
        F.floor(F.col("o_totalprice") / 1000).alias("numVotes"),
    )


def order_akas(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    flagged = orders.withColumns({
        "titleId": F.col("o_orderkey").cast("string"), "isOriginalTitle": F.col("o_orderstatus") == "F",
    })
    again = flagged.filter(F.col("o_orderpriority") == "1-URGENT")
    return flagged.unionByName(again).select("titleId", "isOriginalTitle")


def credits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem", "l_orderkey", "l_suppkey", "l_partkey").select(
        F.col("l_orderkey").cast("string").alias("tconst"),
        F.col("l_suppkey").cast("string").alias("director_id"),
        F.col("l_partkey").cast("string").alias("writer_id"),
    )


def order_crew(spark: SparkSession, folder: str) -> DataFrame:
    rows = credits(spark, folder)
    orders = table(spark, folder, "orders", "o_orderkey").select(F.col("o_orderkey").cast("string").alias("tconst"))
    lists = {"directors": (rows, ["tconst"], "director_id"), "writers": (rows, ["tconst"], "writer_id")}
    crew = attach_list(orders, lists, distinct=True)
    return crew.withColumns({name: F.array_join(name, " ,") for name in lists})


def order_principals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem", "l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus").select(
        F.col("l_orderkey").cast("string").alias("tconst"),
        F.col("l_suppkey").cast("string").alias("nconst"),
        F.when(F.col("l_returnflag") == "A", "\\N").otherwise(F.col("l_returnflag")).alias("category"),
        F.col("l_linestatus").alias("characters"),
    )


def names(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as people; those with a low balance have no entry."""
    suppliers = table(spark, folder, "supplier").filter(F.col("s_acctbal") > 3000)
    return suppliers.select(F.col("s_suppkey").cast("string").alias("nconst"), F.col("s_name").alias("primaryName"))

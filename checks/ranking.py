"""Top-n lists, extremes, fixed orders, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query, table
from reelmill.functions.columns import left_closed_bucket
from reelmill.operators import ranking as R
from reelmill.operators.lists import explode_list

SUPPLIERS = "SELECT s_suppkey, s_name, s_acctbal FROM supplier"


@query("top_n", f"SELECT * FROM ({SUPPLIERS}) ORDER BY s_acctbal DESC, s_suppkey LIMIT 10")
def _(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name", "s_acctbal")
    return R.top_n(suppliers, "s_acctbal", 10, tie=["s_suppkey"])


@query("top_n_smallest", f"SELECT * FROM ({SUPPLIERS}) ORDER BY s_acctbal, s_suppkey LIMIT 10")
def _(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name", "s_acctbal")
    return R.top_n(suppliers, "s_acctbal", 10, desc=False, tie=["s_suppkey"])


WORDS = "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part"
TOP_WORDS = f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word HAVING count(*) >= 50 ORDER BY n DESC, word LIMIT 6"


def words(spark: SparkSession, folder: str) -> DataFrame:
    return explode_list(table(spark, folder, "part", "p_partkey", "p_name"), ["p_partkey"], "p_name", "word", sep=" ")


@query("top_k_frequent", TOP_WORDS)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.top_k_frequent(words(spark, folder), "word", 6, min_count=50)


@query("keep_frequent", f"SELECT p_partkey, word FROM ({WORDS}) WHERE word IN (SELECT word FROM ({TOP_WORDS}))")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.keep_frequent(words(spark, folder), "word", 6, min_count=50).select("p_partkey", "word")


ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


@query("arg_extreme", f"""
SELECT * FROM ({ORDERS}) QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) = 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    return R.arg_extreme(orders, "o_totalprice", ["o_orderstatus"], ["o_orderkey"])


@query("arg_extreme_overall", f"SELECT * FROM ({ORDERS}) ORDER BY o_totalprice, o_orderkey LIMIT 1")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    return R.arg_extreme(orders, "o_totalprice", tie=["o_orderkey"], largest=False)


@query("arg_extremes", f"""
SELECT 'most' AS extreme, * FROM ({ORDERS})
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) = 1
UNION ALL SELECT 'least', * FROM ({ORDERS})
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) = 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    return R.arg_extremes(orders, "o_totalprice", ["o_orderstatus"], ["o_orderkey"], ("most", "least"))


@query("rank_rows", f"""
SELECT *, CAST(row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS INTEGER) AS rank FROM ({SUPPLIERS})
QUALIFY rank <= 10
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name", "s_acctbal")
    return R.rank_rows(suppliers, "s_acctbal", 10, tie=["s_suppkey"])


LINES = "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem"


@query("top_n_per_group", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey)
               AS INTEGER) AS place FROM ({LINES}) QUALIFY place <= 3
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    tie = ["l_orderkey", "l_linenumber", "l_partkey"]
    return R.top_n_per_group(lines, ["l_suppkey"], "l_extendedprice", 3, tie=tie, rank="place")


SIZES = ["small", "medium", "large", "huge"]


@query("reorder_fill", """
SELECT w.bucket, CAST(w.position AS INTEGER) AS position, coalesce(c.n, 0) AS n
FROM (VALUES ('huge', 1), ('large', 2), ('medium', 3), ('small', 4)) w(bucket, position) LEFT JOIN (
  SELECT CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' WHEN p_size < 60 THEN 'large' ELSE 'huge' END
         AS bucket, count(*) AS n FROM part GROUP BY 1) c ON w.bucket = c.bucket
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    bucket = left_closed_bucket(F.col("p_size"), [10, 30, 60], SIZES).alias("bucket")
    counts = table(spark, folder, "part").select(bucket).groupBy("bucket").agg(F.count("*").alias("n"))
    return R.reorder_fill(counts, "bucket", SIZES[::-1], {"n": 0})


@query("sample_rows", """
SELECT * FROM lineitem ORDER BY md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':42'), l_orderkey, l_linenumber, l_partkey
LIMIT 5000
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.sample_rows(table(spark, folder, "lineitem"), 5000, 42, ["l_orderkey", "l_linenumber", "l_partkey"])

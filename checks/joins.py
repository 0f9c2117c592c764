"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import as_text, query, settle, table
from reelmill.operators import joins as J
from reelmill.operators.ranking import top_k_frequent, top_n


@query("inner_on_key", """
SELECT d.doc_id, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "n_chars")
    return J.inner_on_key(documents, table(spark, folder, "labels"), "doc_id")


@query("left_on_key", """
SELECT d.doc_id, n_chars, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "n_chars")
    return as_text(J.left_on_key(documents, table(spark, folder, "labels"), "doc_id"), "quality", "toxic")


@query("left_on_composite", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(a.n AS VARCHAR) AS n, round(a.quantity, 4) AS quantity
FROM lineitem l LEFT JOIN (
  SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN l_linenumber + 100 ELSE l_linenumber END AS l_linenumber,
         count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2) a ON l.l_orderkey = a.l_orderkey AND l.l_linenumber = a.l_linenumber
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem")
    # Returned lines get numbers that no line has, so that some rows find no partner.
    number = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber") + 100).otherwise(F.col("l_linenumber"))
    sums = lines.withColumn("l_linenumber", number).groupBy(*keys).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
    return as_text(settle(J.left_on_composite(lines.select(*keys, "l_partkey"), sums, keys)), "n")


@query("left_renamed_keys", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").filter(F.col("c_acctbal") >= 0)
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    return J.left_renamed_keys(orders, customer.select("c_custkey", "c_name", "c_mktsegment"), {"o_custkey": "c_custkey"})


@query("left_on_key_skewed", """
SELECT s.s_suppkey, s_name, CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber
FROM supplier s LEFT JOIN (SELECT CASE WHEN l_returnflag = 'N' THEN 3 WHEN l_suppkey <= 4 THEN l_suppkey + 4 ELSE l_suppkey END
                                  AS s_suppkey, l_orderkey, l_linenumber FROM lineitem) l ON s.s_suppkey = l.s_suppkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("l_suppkey") <= 4, F.col("l_suppkey") + 4).otherwise(F.col("l_suppkey"))
    hot = F.when(F.col("l_returnflag") == "N", 3).otherwise(moved).alias("s_suppkey")
    lines = table(spark, folder, "lineitem").select(hot, "l_orderkey", "l_linenumber")
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name")
    return as_text(J.left_on_key(suppliers, lines, "s_suppkey", skewed=True, task_rows=1000), "l_orderkey", "l_linenumber")


@query("chain_join", """
SELECT r_name, n_name, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
WHERE c_custkey IS NOT NULL GROUP BY r_name, n_name
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_quantity")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"))
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"))
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nationkey"), "n_name", F.col("n_regionkey").alias("regionkey"))
    region = table(spark, folder, "region").select(F.col("r_regionkey").alias("regionkey"), "r_name")
    joined = J.chain_join(lines, [
        (orders, "orderkey", "inner"), (customer, "custkey", "left"),
        (nation, "nationkey", "left"), (region, "regionkey", "left"),
    ])
    kept = joined.filter(F.col("custkey").isNotNull()).groupBy("r_name", "n_name")
    return kept.agg(F.count("*").alias("lines"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("lookup_default", """
SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(s_name, 'Unknown') AS supplier
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 5000) ON l_suppkey = s_suppkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rich = table(spark, folder, "supplier").filter(F.col("s_acctbal") >= 5000)
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    return J.lookup_default(lines, rich, "l_suppkey", "s_suppkey", "s_name", "Unknown", "supplier")


@query("semi_in_set", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (
  SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 10)
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return J.semi_in_set(lines, top_k_frequent(lines, "l_partkey", 10), ["l_partkey"])


@query("detail_lookup", """
SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), '|') AS l_returnflag,
       array_to_string(list_sort(list(DISTINCT l_linestatus)), '|') AS l_linestatus
FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 10)
GROUP BY l_suppkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    best = top_n(table(spark, folder, "supplier"), "s_acctbal", 10, tie=["s_suppkey"])
    chosen = best.select(F.col("s_suppkey").alias("l_suppkey"))
    lines = table(spark, folder, "lineitem")
    return settle(J.detail_lookup(chosen, lines, "l_suppkey", ["l_returnflag", "l_linestatus"]))


@query("orphan_keys", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return J.orphan_keys(table(spark, folder, "orders", "o_orderkey", "o_custkey"), known, "o_custkey", "c_custkey")


@query("orphan_labels", """
SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    english = table(spark, folder, "documents", "doc_id", "lang").filter(F.col("lang") == "en")
    return J.orphan_keys(table(spark, folder, "labels", "doc_id"), english, "doc_id", "doc_id")

"""Projections, casts, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import as_text, query, settle, table
from reelmill.functions import columns as C
from reelmill.operators import shaping as S


@query("cast_columns", """
SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no, CAST(TRY_CAST(p_name AS INTEGER) AS VARCHAR) AS not_a_number,
       TRY_CAST(CAST(p_size AS VARCHAR) || '.5' AS DOUBLE) AS half, p_size AS cut
FROM part
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "part", "p_partkey", "p_brand", "p_name", "p_size").select(
        "p_partkey",
        F.expr("substring(p_brand, 7)").alias("brand_no"),
        F.col("p_name").alias("not_a_number"),
        F.concat(F.col("p_size").cast("string"), F.lit(".5")).alias("half"),
        F.concat(F.col("p_size").cast("string"), F.lit(".5")).alias("cut"),
    )
    numbers = S.cast_columns(texts, {"brand_no": "int", "not_a_number": "int", "half": "double", "cut": "int"})
    return as_text(numbers, "not_a_number")


@query("to_numeric", """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
       TRY_CAST(o_orderpriority AS DOUBLE) AS nothing FROM orders
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "orders", "o_orderkey", "o_orderpriority").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderpriority").alias("nothing")
    )
    return S.to_numeric(texts, ["priority", "nothing"])


@query("flag_to_boolean", """
SELECT doc_id, CASE toxic WHEN 1 THEN true WHEN 0 THEN false END AS toxic FROM labels
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return S.flag_to_boolean(table(spark, folder, "labels", "doc_id", "toxic"), "toxic")


@query("flag_to_int", "SELECT doc_id, toxic FROM labels")
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("string").alias("toxic"))
    return S.flag_to_int(texts, "toxic")


@query("strip_list_markup", """
SELECT event_id, replace(replace(replace('[' || props || ']', '[', ''), ']', ''), '"', '') AS props FROM events
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "events").select("event_id", F.concat(F.lit("["), "props", F.lit("]")).alias("props"))
    return S.strip_list_markup(listed, "props")


@query("null_marker_filter", "SELECT p_partkey, p_name FROM part WHERE p_size > 10 AND p_type <> 'PROMO'")
def _(spark: SparkSession, folder: str) -> DataFrame:
    name = (
        F.when(F.col("p_size") <= 10, C.NULL_MARKER)
        .when(F.col("p_type") != "PROMO", F.col("p_name"))
        .alias("p_name")
    )
    return S.null_marker_filter(table(spark, folder, "part").select("p_partkey", name), ["p_name"])


LABELLED = """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "lang")
    return documents.join(table(spark, folder, "labels"), "doc_id", "left")


@query("drop_missing", f"SELECT * FROM ({LABELLED}) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return S.drop_missing(labelled_documents(spark, folder), ["quality", "toxic"])


@query("fill_missing", f"""
SELECT doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM ({LABELLED})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return S.fill_missing(labelled_documents(spark, folder), {"quality": -1, "toxic": 0})


@query("coalesce_text", f"SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'Unknown') AS shown FROM ({LABELLED})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return labelled_documents(spark, folder).select("doc_id", C.text_or(F.col("quality"), "Unknown").alias("shown"))


@query("range_filter", """
SELECT p_partkey, p_size, p_retailprice FROM part
WHERE p_size BETWEEN 5 AND 40 AND p_retailprice BETWEEN 900.5 AND 980
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part", "p_partkey", "p_size", "p_retailprice")
    return S.range_filter(part, {"p_size": (5, 40), "p_retailprice": (900.5, 980)})


@query("equals_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return S.equals_filter(table(spark, folder, "orders", "o_orderkey", "o_orderstatus"), "o_orderstatus", "F")


@query("select_columns", "SELECT s_suppkey, s_name FROM supplier")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return S.select_columns(table(spark, folder, "supplier"), ["s_suppkey", "s_name"])


@query("rename", "SELECT s_suppkey AS person_id, s_name AS person_name FROM supplier")
def _(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier", "s_suppkey", "s_name")
    return S.rename(supplier, {"s_suppkey": "person_id", "s_name": "person_name"})


@query("label_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status_word FROM orders
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderstatus")
    words = {"F": "finished", "O": "open"}
    return S.label_map(orders, "o_orderstatus", words, "status_word").drop("o_orderstatus")


@query("bucket_left_closed", """
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'tiny' WHEN p_size < 20 THEN 'small' WHEN p_size < 35 THEN 'medium'
       WHEN p_size >= 35 THEN 'large' END AS bucket FROM part
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part", "p_partkey", "p_size")
    labels = ["tiny", "small", "medium", "large"]
    return S.bucket_left_closed(part, "p_size", [10, 20, 35], labels, "bucket").drop("p_size")


@query("bucket_right_closed", """
SELECT l_orderkey, l_quantity, CASE WHEN l_quantity > 5 AND l_quantity <= 10 THEN 'low'
       WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'middle'
       WHEN l_quantity > 25 AND l_quantity <= 45 THEN 'high' END AS bucket FROM lineitem
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_quantity")
    return S.bucket_right_closed(lines, "l_quantity", [5, 10, 25, 45], ["low", "middle", "high"], "bucket")


@query("decade", "SELECT o_orderkey, CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade FROM orders")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderdate")
    return orders.select("o_orderkey", C.decade(F.year("o_orderdate")).alias("decade"))


@query("log_measure", """
SELECT c_custkey, round(log10(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 4) AS magnitude FROM customer
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer", "c_custkey", "c_acctbal")
    return settle(customer.select("c_custkey", C.log_measure(F.col("c_acctbal")).alias("magnitude")))


@query("weighted_score", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * log10(l_quantity + 1), 3) AS score FROM lineitem
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    score = C.weighted_score(F.col("l_extendedprice"), F.col("l_quantity")).alias("score")
    return settle(lines.select("l_orderkey", "l_linenumber", "l_partkey", score), 3)


@query("percentage", """
SELECT lang, round(CAST(sum(toxic) AS DOUBLE) / nullif(count(toxic), 0) * 100, 4) AS toxic_pct
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder).groupBy("lang")
    return settle(rows.agg(C.percentage(F.sum("toxic"), F.count("toxic")).alias("toxic_pct")))


@query("unit_ratio", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / 60, 4) AS hours FROM lineitem")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    hours = C.unit_ratio(F.col("l_quantity"), 60).alias("hours")
    return settle(lines.select("l_orderkey", "l_linenumber", "l_partkey", hours))


@query("round_stats", """
SELECT l_suppkey, round(avg(l_quantity), 2) AS quantity, round(avg(l_extendedprice), 2) AS price
FROM lineitem GROUP BY l_suppkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_suppkey", "l_quantity", "l_extendedprice").groupBy("l_suppkey")
    means = lines.agg(F.avg("l_quantity").alias("quantity"), F.avg("l_extendedprice").alias("price"))
    return S.round_stats(means, ["quantity", "price"], 2)


@query("sort_rows", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return S.sort_rows(table(spark, folder, "customer", "c_custkey", "c_acctbal"), ["c_acctbal"], desc=True)


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return S.distinct_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("text_trim", "SELECT c_custkey, c_name AS shown FROM customer")
def _(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("c_name"), F.lit("\n "))
    return table(spark, folder, "customer").select("c_custkey", C.text_trim(padded).alias("shown"))


@query("text_prefix", "SELECT c_custkey, substr(c_mktsegment, 1, 4) AS shown FROM customer")
def _(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer", "c_custkey", "c_mktsegment")
    return customer.select("c_custkey", C.text_prefix(F.col("c_mktsegment"), 4).alias("shown"))

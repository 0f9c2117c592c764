"""Data-quality profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import as_text, query, settle, table
from checks.shaping import LABELLED, labelled_documents
from reelmill.functions.columns import array_is_empty, split_to_array
from reelmill.operators import profile as P


@query("null_counts", f"""
SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(lang) AS lang, count(*) - count(quality) AS quality,
       count(*) - count(toxic) AS toxic FROM ({LABELLED})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.null_counts(labelled_documents(spark, folder))


@query("null_counts_long", f"""
SELECT 'quality' AS column_name, count(*) - count(quality) AS nulls FROM ({LABELLED})
UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM ({LABELLED})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.null_counts(labelled_documents(spark, folder), ["quality", "toxic"], long=True)


@query("range_profile", """
SELECT min(o_totalprice) AS "min_o_totalprice", max(o_totalprice) AS "max_o_totalprice",
       min(o_orderstatus) AS "min_o_orderstatus", max(o_orderstatus) AS "max_o_orderstatus" FROM orders
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.range_profile(table(spark, folder, "orders"), ["o_totalprice", "o_orderstatus"])


@query("rule_violations", """
SELECT count(*) FILTER (WHERE c_acctbal < 0) AS negative_balance,
       count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS wrong_segment FROM customer
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.rule_violations(table(spark, folder, "customer"), {
        "negative_balance": F.col("c_acctbal") < 0, "wrong_segment": F.col("c_mktsegment") == "BUILDING",
    })


@query("rule_violations_long", """
SELECT 'late_order' AS rule, count(*) FILTER (WHERE year(o_orderdate) > 1999) AS violations FROM orders
UNION ALL SELECT 'cheap_order', count(*) FILTER (WHERE o_totalprice < 2000) FROM orders
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.rule_violations(table(spark, folder, "orders"), {
        "late_order": F.year("o_orderdate") > 1999, "cheap_order": F.col("o_totalprice") < 2000,
    }, long=True)


@query("duplicate_keys", """
SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicated_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.duplicated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distribution", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.distribution(table(spark, folder, "events"), "event_type")


@query("distribution_with_missing", f"SELECT CAST(quality AS VARCHAR) AS quality, count(*) AS n FROM ({LABELLED}) GROUP BY 1")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(P.distribution(labelled_documents(spark, folder), "quality"), "quality")


@query("distribution_share", """
SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct
FROM events GROUP BY event_type
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(P.distribution_share(table(spark, folder, "events"), "event_type"))


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return P.distinct_values(table(spark, folder, "orders"), "o_orderpriority")


@query("distinct_values_by", """
SELECT o_orderstatus, array_to_string(list_sort(list(DISTINCT o_orderpriority))[1:3], '|') AS o_orderpriority
FROM orders WHERE o_orderpriority <> '2-HIGH' GROUP BY o_orderstatus
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return settle(P.distinct_values(orders, "o_orderpriority", ["o_orderstatus"], n=3, marker="2-HIGH"))


@query("quality_metrics", """
SELECT 'documents' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE lang IS NULL) AS missing_titles,
       0 AS missing_genres FROM documents
UNION ALL SELECT 'part', count(*), count(*) FILTER (WHERE p_name IS NULL), count(*) FILTER (WHERE p_size <= 10) FROM part
UNION ALL SELECT 'orders', count(*), 0, 0 FROM orders
UNION ALL SELECT 'labels', count(*), 0, 0 FROM labels
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    words = split_to_array(F.when(F.col("p_size") > 10, F.col("p_name")), " ")
    return P.quality_metrics({
        "documents": (table(spark, folder, "documents"), {"missing_titles": F.col("lang").isNull()}),
        "part": (table(spark, folder, "part"), {
            "missing_titles": F.col("p_name").isNull(), "missing_genres": array_is_empty(words)}),
        "orders": (table(spark, folder, "orders"), {}),
        "labels": (table(spark, folder, "labels"), {}),
    })

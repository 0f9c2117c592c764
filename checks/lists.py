"""Lists in text form: explode, attach, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query, settle, table
from reelmill.functions.columns import array_is_empty, split_to_array
from reelmill.operators.lists import NO_PEOPLE, attach_list, element_frequencies, explode_list, format_counts


@query("explode_list", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return explode_list(table(spark, folder, "part", "p_partkey", "p_name"), ["p_partkey"], "p_name", "word", sep=" ")


@query("explode_list_strict", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part", "p_partkey", "p_name")
    padded = part.withColumn("p_name", F.concat(F.lit(" , "), F.regexp_replace("p_name", " ", " ,, "), F.lit(",")))
    return explode_list(padded, ["p_partkey"], "p_name", "word", trim=True, drop_empty=True)


PIECES = """
SELECT doc_id, trim(unnest(string_split(text, ',')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS piece
FROM documents
"""


@query("explode_list_people", f"SELECT doc_id, md5(piece) AS piece_md5, length(piece) AS piece_length FROM ({PIECES})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    pieces = explode_list(documents, ["doc_id"], "text", "piece", trim=True, skip=NO_PEOPLE)
    return pieces.select("doc_id", F.md5("piece").alias("piece_md5"), F.char_length("piece").cast("long").alias("piece_length"))


@query("attach_list", """
SELECT o_orderkey, CAST(len(p.list) AS VARCHAR) AS n_parts, array_to_string(p.list, '|') AS parts,
       coalesce(len(s.list), 0) AS n_suppliers, coalesce(array_to_string(s.list, '|'), '') AS suppliers
FROM orders
LEFT JOIN (SELECT l_orderkey, list_sort(list(l_partkey)) AS list FROM lineitem GROUP BY 1) p ON o_orderkey = p.l_orderkey
LEFT JOIN (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS list FROM lineitem GROUP BY 1) s
  ON o_orderkey = s.l_orderkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderkey")
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    with_parts = attach_list(orders, {"parts": (lines, ["o_orderkey"], "l_partkey")})
    both = attach_list(with_parts, {"suppliers": (lines, ["o_orderkey"], "l_suppkey")}, empty="array", distinct=True)
    return settle(both.select(
        "o_orderkey",
        F.when(F.col("parts").isNotNull(), F.size("parts")).cast("string").alias("n_parts"), "parts",
        F.size("suppliers").cast("long").alias("n_suppliers"), "suppliers",
    ))


@query("multi_child_left", """
SELECT p_partkey, len(string_split(p_name, ' ')) AS n_words, coalesce(s.n, 0) AS n_suppliers,
       coalesce(o.n, 0) AS n_orders, array_to_string(list_sort(string_split(p_name, ' ')), '|') AS words
FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) s ON p_partkey = s.l_partkey
LEFT JOIN (SELECT l_partkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1) o ON p_partkey = o.l_partkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part", "p_partkey", "p_name")
    words = explode_list(part, ["p_partkey"], "p_name", "word", sep=" ")
    lines = table(spark, folder, "lineitem", "l_partkey", "l_suppkey", "l_orderkey").withColumnRenamed("l_partkey", "p_partkey")
    keys = ["p_partkey"]
    listed = attach_list(part.select(*keys), {"words": (words, keys, "word")})
    both = {"suppliers": (lines, keys, "l_suppkey"), "orders": (lines, keys, "l_orderkey")}
    joined = attach_list(listed, both, empty="array", distinct=True)
    return settle(joined.select(
        "p_partkey", *[F.size(c).cast("long").alias(f"n_{c}") for c in ("words", "suppliers", "orders")], "words"))


@query("attach_list_composite", """
SELECT l.l_orderkey, l.l_linenumber, array_to_string(list_sort(list(l.l_partkey)), '|') AS parts
FROM lineitem l GROUP BY 1, 2
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    keys = ["l_orderkey", "l_linenumber"]
    return settle(attach_list(lines.select(*keys).distinct(), {"parts": (lines, keys, "l_partkey")}))


@query("split_to_array", """
SELECT p_partkey, coalesce(len(CASE WHEN p_size > 10 THEN string_split(p_name, ' ') END), 0) AS words FROM part
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    named = F.when(F.col("p_size") > 10, F.col("p_name"))
    return table(spark, folder, "part").select(
        "p_partkey", F.size(split_to_array(named, " ")).cast("long").alias("words")
    )


@query("array_is_empty", "SELECT p_partkey, p_size <= 10 AS no_words FROM part")
def _(spark: SparkSession, folder: str) -> DataFrame:
    named = F.when(F.col("p_size") > 10, F.col("p_name"))
    return table(spark, folder, "part").select(
        "p_partkey", array_is_empty(split_to_array(named, " ")).alias("no_words")
    )


WORD_COUNTS = """
SELECT p_brand, word, count(*) AS n
FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY p_brand, word
"""


@query("element_frequencies", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
GROUP BY word ORDER BY n DESC, word LIMIT 5
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return element_frequencies(table(spark, folder, "part"), "p_name", 5, sep=" ", out="word")


@query("element_frequencies_by", f"""
SELECT * FROM ({WORD_COUNTS}) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, word) <= 3
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return element_frequencies(table(spark, folder, "part"), "p_name", 3, by=["p_brand"], sep=" ", out="word")


@query("format_counts", f"""
SELECT p_brand, string_agg(word || '(' || n || ')', ', ' ORDER BY n DESC, word) AS summary
FROM (SELECT * FROM ({WORD_COUNTS}) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, word) <= 3)
GROUP BY p_brand
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = element_frequencies(table(spark, folder, "part"), "p_name", by=["p_brand"], sep=" ", out="word")
    return format_counts(counts, ["p_brand"], "word", "n", 3)

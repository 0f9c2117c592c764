"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import as_text, query, table
from reelmill.functions.columns import NULL_MARKER
from reelmill.operators.chunks import assign_chunks, chunk_manifest, dataset_manifest, total_manifest
from reelmill.operators.lists import explode_list
from reelmill.operators.profile import row_counts
from reelmill.plans.audit import ingestion_audit
from reelmill.session import fresh_path
from reelmill.sources.fingerprints import detect_changes, source_fingerprint, table_fingerprint
from reelmill.sources.readers import read_delimited, read_parts, register_views, scan_parquet, union_parts
from reelmill.sources.sinks import (
    append_ingestion_log,
    create_event_table,
    read_event_table,
    read_ingestion_log,
    read_table,
    write_counted,
    write_event_table,
    write_row_limited,
    write_table_overwrite,
    write_with_children,
)

DUMP_COLUMNS = ["key", "name", "size", "brand"]
DUMP_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in DUMP_COLUMNS])
DUMP_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS "key", '"' || p_name AS "name",
       CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS "size",
       CASE WHEN p_type <> 'PROMO' THEN p_brand END AS "brand"
FROM part
"""


def write_dump(spark: SparkSession, folder: str, compression: str) -> str:
    """The part table as a delimited dump: unbalanced quotes, null markers and empty fields."""
    part = table(spark, folder, "part")
    size = F.when(F.col("p_size") > 25, F.col("p_size").cast("string"))
    brand = F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_brand"))
    rows = part.select(F.col("p_partkey").cast("string").alias("key"), F.concat(F.lit('"'), "p_name").alias("name"), size.alias("size"),
                       brand.alias("brand"))
    path = fresh_path(spark, "dump")
    # Every task writes a file of its own, with a header.
    rows.repartition("key").write.csv(path, sep="\t", header=True, nullValue=NULL_MARKER, emptyValue="", quote="", escape="\u0001",
                                      compression=compression)
    return path


@query("read_delimited", DUMP_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return read_delimited(spark, write_dump(spark, folder, "none"), DUMP_SCHEMA)


@query("read_delimited_gz", DUMP_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = write_dump(spark, folder, "gzip")
    return read_delimited(spark, f"{path}/*.gz", DUMP_SCHEMA)


@query("scan_parquet", "SELECT n_nationkey, n_name FROM nation")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return scan_parquet(spark, f"{folder}/nation.parquet", ["n_nationkey", "n_name"])


@query("union_parts", """
SELECT l_orderkey, l_linenumber, l_linestatus, l_quantity FROM lineitem
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_linestatus", "l_quantity")
    open_lines = lines.filter(F.col("l_linestatus") == "O")
    return union_parts([open_lines, lines.filter(F.col("l_linestatus") != "O")])


@query("read_parts", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def _(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_path(spark, "parts")
    table(spark, folder, "nation").select(F.col("n_name").alias("name")).write.parquet(f"{root}/a")
    table(spark, folder, "region").select(F.col("r_name").alias("name")).write.parquet(f"{root}/b")
    return read_parts(spark, [f"{root}/a", f"{root}/b"])


@query("write_row_limited", """
SELECT o_orderkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "row-limited")
    write_row_limited(table(spark, folder, "orders"), path, 2000)
    stored = spark.read.parquet(path)
    return as_text(stored.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate")), "o_orderdate")


CHUNKED = """
SELECT *, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders
"""


@query("assign_chunks", f"""
SELECT o_orderkey, row_number, CAST((row_number - 1) // 1000 + 1 AS BIGINT) AS chunk FROM ({CHUNKED})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return assign_chunks(table(spark, folder, "orders", "o_orderkey"), ["o_orderkey"], 1000)


@query("chunk_manifest", f"""
SELECT CAST((row_number - 1) // 1000 + 1 AS BIGINT) AS chunk, count(*) AS "rows",
       min(row_number) - 1 AS start_row, max(row_number) - 1 AS end_row
FROM ({CHUNKED}) GROUP BY 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_manifest(assign_chunks(table(spark, folder, "orders"), ["o_orderkey"], 1000))


@query("total_manifest", """
WITH each AS (
  SELECT 'orders' AS dataset, count(*) AS n, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS chunks FROM orders
  UNION ALL SELECT 'lineitem', count(*), CAST(ceil(count(*) / 5000.0) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'nation', count(*), CAST(ceil(count(*) / 1000.0) AS BIGINT) FROM nation)
SELECT dataset, n AS total_rows, chunks, n // chunks AS mean_rows FROM each
UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT), CAST(sum(chunks) AS BIGINT), CAST(sum(n) // sum(chunks) AS BIGINT) FROM each
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Line items have no order of their own here, and many rows of it are equal in the two columns.
    lines = table(spark, folder, "lineitem", "l_quantity", "l_linenumber")
    return total_manifest({
        "orders": assign_chunks(table(spark, folder, "orders"), ["o_orderkey"], 1000),
        "lineitem": assign_chunks(lines, ["l_quantity"], 5000),
        "nation": assign_chunks(table(spark, folder, "nation"), ["n_nationkey"], 1000),
    })


@query("dataset_manifest", """
SELECT 'orders' AS dataset, count(*) AS total_rows, 6 AS columns,
       CAST(ceil(count(*) / 1000) AS BIGINT) AS chunks,
       CAST(floor(count(*) / ceil(count(*) / 1000)) AS BIGINT) AS mean_rows
FROM orders
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return dataset_manifest(assign_chunks(table(spark, folder, "orders"), ["o_orderkey"], 1000), "orders")


@query("write_table_overwrite", "SELECT r_regionkey, r_name FROM region")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "overwrite")
    write_table_overwrite(table(spark, folder, "nation"), path)
    write_table_overwrite(table(spark, folder, "region"), path)
    return read_table(spark, path)


@query("write_with_children", """
SELECT 'main' AS source, p_partkey, p_name AS word FROM part
UNION ALL SELECT 'words', p_partkey, unnest(string_split(p_name, ' ')) FROM part
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    main = table(spark, folder, "part", "p_partkey", "p_name")
    words = explode_list(main, ["p_partkey"], "p_name", "word", sep=" ")
    written = write_with_children(main, {"words": words}, fresh_path(spark, "part"))
    stored = read_table(spark, written[""]).select(F.lit("main").alias("source"), "p_partkey", F.col("p_name").alias("word"))
    children = read_table(spark, written["words"]).select(F.lit("words").alias("source"), "p_partkey", "word")
    return stored.unionByName(children)


@query("register_views", """
SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    register_views({"v_nation": table(spark, folder, "nation"), "v_region": table(spark, folder, "region")})
    return spark.sql(
        "SELECT r_name, count(*) AS nations FROM v_nation JOIN v_region ON n_regionkey = r_regionkey GROUP BY r_name"
    )


@query("create_event_table", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type, count(*) AS n, CAST(count(DISTINCT user_id) AS BIGINT) AS users
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' GROUP BY 1, 2
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = fresh_path(spark, "event-table")
    create_event_table(spark, path, events.schema, ts="ts")
    write_event_table(events, path, ts="ts", cluster=["user_id", "event_type"])
    days = read_event_table(spark, path, events.schema).filter(F.col("event_date") >= F.lit("2024-01-10").cast("date"))
    counts = days.groupBy("event_date", "event_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users")
    )
    return as_text(counts, "event_date")


ORDER_FINGERPRINT_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def fingerprint_sql(rows: str, by: str = "") -> str:
    """The order-independent hash of the listed order columns in SQL."""
    head, tail = (f"{by} AS dataset_name, ", f"GROUP BY {by}") if by else ("", "")
    lanes = " || ':' || ".join(
        f"CAST(sum(CAST(('0x' || substr(h, {1 + 8 * i}, 8)) AS BIGINT)) AS VARCHAR)" for i in range(4)
    )
    return f"""
    SELECT {head}count(*) AS n, md5(CAST(count(*) AS VARCHAR) || ':' || {lanes}) AS md5_hash
    FROM (SELECT *, md5(CAST(o_orderkey AS VARCHAR) || chr(1) || CAST(o_custkey AS VARCHAR) || chr(1)
                        || o_orderstatus || chr(1) || o_orderpriority) AS h FROM ({rows})) {tail}
    """


@query("table_fingerprint", fingerprint_sql("SELECT * FROM orders"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return table_fingerprint(table(spark, folder, "orders"), ORDER_FINGERPRINT_COLUMNS)


ALTERED = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       o_orderpriority FROM orders
"""


def altered_orders(orders: DataFrame) -> DataFrame:
    changed = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")
    return orders.withColumn("o_orderstatus", F.when(changed, "F").otherwise(F.col("o_orderstatus")))


def priority_fingerprints(orders: DataFrame) -> DataFrame:
    prints = table_fingerprint(orders, ORDER_FINGERPRINT_COLUMNS, by=["o_orderpriority"])
    return prints.select(
        F.col("o_orderpriority").alias("dataset_name"), F.col("n").alias("file_size_bytes"), "md5_hash"
    )


@query("detect_changes", f"""
WITH before AS ({fingerprint_sql("SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'", "o_orderpriority")}),
now AS ({fingerprint_sql(ALTERED, "o_orderpriority")}),
expected AS (SELECT dataset_name FROM now UNION SELECT 'missing')
SELECT e.dataset_name, n.dataset_name IS NOT NULL AS present,
       n.dataset_name IS NOT NULL AND n.md5_hash IS DISTINCT FROM b.md5_hash AS has_changed
FROM expected e LEFT JOIN now n ON e.dataset_name = n.dataset_name
LEFT JOIN before b ON e.dataset_name = b.dataset_name
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", *ORDER_FINGERPRINT_COLUMNS)
    earlier = priority_fingerprints(orders.filter(F.col("o_orderpriority") != "5-LOW"))
    log = earlier.withColumn("ingestion_date", F.lit("2024-01-01").cast("timestamp"))
    current = priority_fingerprints(altered_orders(orders))
    missing = spark.createDataFrame([("missing",)], "dataset_name string")
    expected = current.select("dataset_name").unionByName(missing)
    return detect_changes(current, log, expected).select("dataset_name", "present", "has_changed")


@query("ingestion_audit", f"""
WITH before AS ({fingerprint_sql("SELECT * FROM orders", "o_orderpriority")}),
now AS ({fingerprint_sql(ALTERED, "o_orderpriority")})
SELECT 1 AS run, dataset_name, true AS has_changed FROM before
UNION ALL SELECT 2, dataset_name, false FROM before
UNION ALL SELECT 3, n.dataset_name, n.md5_hash <> b.md5_hash FROM now n JOIN before b ON n.dataset_name = b.dataset_name
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", *ORDER_FINGERPRINT_COLUMNS)
    log = fresh_path(spark, "ingestion-log")
    states = [orders, orders, altered_orders(orders)]
    runs = [
        ingestion_audit(priority_fingerprints(state), log).select(F.lit(run).alias("run"), "dataset_name", "has_changed")
        for run, state in enumerate(states, 1)
    ]
    return union_parts(runs)


@query("append_ingestion_log", f"""
SELECT dataset_name, n AS file_size_bytes, md5_hash, true AS has_changed
FROM ({fingerprint_sql("SELECT * FROM orders", "o_orderpriority")})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    prints = priority_fingerprints(table(spark, folder, "orders", *ORDER_FINGERPRINT_COLUMNS))
    log = fresh_path(spark, "ingestion-log")
    rows = prints.withColumns({"ingestion_date": F.current_timestamp(), "has_changed": F.lit(True)})
    append_ingestion_log(rows, log)
    return read_ingestion_log(spark, log).drop("ingestion_date")


LINE_LANES = " || ':' || ".join(f"CAST(sum(CAST(('0x' || substr(md5(line), {1 + 8 * i}, 8)) AS BIGINT)) AS VARCHAR)" for i in range(4))


@query("source_fingerprint", f"""
SELECT o_orderpriority AS dataset_name, CAST(sum(length(line) + 1) AS BIGINT) AS file_size_bytes,
       md5(CAST(count(*) AS VARCHAR) || ':' || {LINE_LANES}) AS md5_hash
FROM (SELECT o_orderpriority, o_orderkey || ',' || o_custkey || ',' || o_orderstatus AS line FROM orders) GROUP BY 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "dumps")
    lines = table(spark, folder, "orders").select(
        F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus").alias("line"), "o_orderpriority")
    lines.write.partitionBy("o_orderpriority").text(path)
    found = source_fingerprint(spark, f"{path}/*/*.txt", dataset="folder")
    # Spark gives files as encoded addresses, and folders have encoded values.
    return found.withColumn("dataset_name", F.url_decode(F.regexp_extract("dataset_name", "=([^/]*)$", 1)))


@query("row_counts", """
SELECT count(*) AS rows_before, count(*) FILTER (WHERE p_size BETWEEN 5 AND 40) AS rows_after FROM part
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return row_counts(part, part.filter(F.col("p_size").between(5, 40)))


@query("write_counted", """
SELECT count(*) AS rows_before, count(*) FILTER (WHERE p_size BETWEEN 5 AND 40) AS rows_after,
       CAST(sum(p_size) FILTER (WHERE p_size BETWEEN 5 AND 40) AS BIGINT) AS sizes
FROM part
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "counted")
    seen = write_counted(table(spark, folder, "part"), lambda df: df.filter(F.col("p_size").between(5, 40)), path)
    return read_table(spark, path).agg(
        F.lit(seen["rows_before"]).cast("long").alias("rows_before"),
        F.lit(seen["rows_after"]).cast("long").alias("rows_after"),
        F.sum("p_size").alias("sizes"),
    )



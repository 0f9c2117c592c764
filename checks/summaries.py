"""Grouped statistics, cross tables, histograms, order statistics, the t-test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query, settle, table
from reelmill.operators import summaries as S
from reelmill.operators.ordered import box_stats, ecdf

LABELLED = "SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
BRANDS = "SELECT p_brand, avg(p_retailprice) AS price, avg(p_size) AS size, stddev_samp(p_size) AS spread FROM part GROUP BY 1"


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "lang", "n_chars")
    return documents.join(table(spark, folder, "labels"), "doc_id")


def brands(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").groupBy("p_brand").agg(
        F.avg("p_retailprice").alias("price"), F.avg("p_size").alias("size"), F.stddev_samp("p_size").alias("spread")
    )


@query("grouped_summary", """
SELECT l_returnflag, count(l_quantity) AS count, round(avg(l_quantity), 4) AS mean, median(l_quantity) AS median,
       round(stddev_samp(l_quantity), 4) AS std, min(l_quantity) AS min, max(l_quantity) AS max
FROM lineitem GROUP BY l_returnflag
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.grouped_summary(table(spark, folder, "lineitem"), ["l_returnflag"], "l_quantity"))


@query("describe_column", """
SELECT count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min,
       round(quantile_cont(value, 0.25), 4) AS q1, round(quantile_cont(value, 0.5), 4) AS median,
       round(quantile_cont(value, 0.75), 4) AS q3, max(value) AS max FROM events
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.describe_column(table(spark, folder, "events"), "value"))


@query("multi_summary", """
SELECT l_suppkey, count(l_quantity) AS l_quantity_count, round(avg(l_quantity), 4) AS l_quantity_mean,
       median(l_quantity) AS l_quantity_median, round(stddev_samp(l_quantity), 4) AS l_quantity_std,
       round(sum(l_extendedprice), 2) AS l_extendedprice_sum, round(median(l_extendedprice), 4) AS l_extendedprice_median,
       max(l_discount) AS l_discount_max
FROM lineitem GROUP BY l_suppkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    summary = S.multi_summary(table(spark, folder, "lineitem"), ["l_suppkey"], {
        "l_quantity": ["count", "mean", "median", "std"], "l_extendedprice": ["sum", "median"], "l_discount": ["max"],
    })
    return settle(summary.withColumn("l_extendedprice_sum", F.round("l_extendedprice_sum", 2)))


@query("multi_summary_plain", """
SELECT l_suppkey, count(l_quantity) AS l_quantity_count, round(avg(l_quantity), 4) AS l_quantity_mean,
       round(stddev_samp(l_quantity), 4) AS l_quantity_std, sum(l_quantity) AS l_quantity_sum,
       min(l_discount) AS l_discount_min FROM lineitem GROUP BY l_suppkey
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"l_quantity": ["count", "mean", "std", "sum"], "l_discount": ["min"]}
    return settle(S.multi_summary(table(spark, folder, "lineitem"), ["l_suppkey"], wanted))


@query("grouped_mean_std", f"""
SELECT toxic, round(avg(n_chars), 4) AS mean, round(stddev_samp(n_chars), 4) AS std FROM ({LABELLED}) GROUP BY toxic
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.grouped_mean_std(labelled(spark, folder), ["toxic"], "n_chars"))


@query("grouped_mean", """
SELECT CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_orderdate", "o_totalprice")
    dated = orders.withColumn("decade", (F.floor(F.year("o_orderdate") / 10) * 10).cast("int"))
    return settle(S.grouped_mean(dated, ["decade"], "o_totalprice"))


@query("flag_rate", f"""
SELECT lang, count(toxic) AS n, CAST(sum(toxic) AS BIGINT) AS flagged, round(avg(toxic), 4) AS share,
       round(avg(toxic) * 100, 4) AS pct FROM ({LABELLED}) GROUP BY lang
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.flag_rate(labelled(spark, folder), ["lang"], "toxic"))


@query("crosstab", """
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS f, count(*) FILTER (WHERE l_linestatus = 'O') AS o,
       count(*) FILTER (WHERE l_linestatus = 'X') AS x, count(*) FILTER (WHERE l_linestatus IN ('F', 'O', 'X')) AS total
FROM lineitem GROUP BY l_returnflag
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return S.crosstab(lines, "l_returnflag", "l_linestatus", ["F", "O", "X"], ["f", "o", "x"], total="total")


@query("crosstab_row_pct", """
SELECT l_returnflag, round(count(*) FILTER (WHERE l_linestatus = 'F') * 100.0 / count(*), 4) AS f,
       round(count(*) FILTER (WHERE l_linestatus = 'O') * 100.0 / count(*), 4) AS o FROM lineitem GROUP BY l_returnflag
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return settle(S.crosstab_row_pct(lines, "l_returnflag", "l_linestatus", ["F", "O"], ["f", "o"]))


@query("min_support", """
SELECT l_suppkey, count(l_quantity) AS l_quantity_count, round(avg(l_quantity), 4) AS l_quantity_mean
FROM lineitem GROUP BY l_suppkey HAVING count(l_quantity) >= 600 AND avg(l_quantity) >= 25
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    summary = S.multi_summary(table(spark, folder, "lineitem"), ["l_suppkey"], {"l_quantity": ["count", "mean"]})
    return settle(S.min_support(summary, {"l_quantity_count": 600, "l_quantity_mean": 25}))


@query("split_totals", """
SELECT count(*) AS total, count(*) FILTER (WHERE toxic = 1) AS toxic, count(*) FILTER (WHERE quality = 1) AS good,
       round(count(*) FILTER (WHERE toxic = 1) * 100.0 / count(*), 4) AS toxic_pct,
       round(count(*) FILTER (WHERE quality = 1) * 100.0 / count(*), 4) AS good_pct FROM labels
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    flags = {"toxic": F.col("toxic") == 1, "good": F.col("quality") == 1}
    return settle(S.split_totals(table(spark, folder, "labels"), flags))


@query("thresholds", f"SELECT round(median(price), 4) AS price, round(median(size), 4) AS size FROM ({BRANDS})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.thresholds(brands(spark, folder), ["price", "size"]))


@query("thresholds_mean", f"SELECT round(avg(price), 4) AS price, round(avg(size), 4) AS size FROM ({BRANDS})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.thresholds(brands(spark, folder), ["price", "size"], "mean"))


@query("quadrant_label", f"""
WITH b AS MATERIALIZED ({BRANDS}), m AS (SELECT median(price) AS mp, median(size) AS ms FROM b)
SELECT p_brand, round(price, 4) AS price, round(size, 4) AS size,
       CASE WHEN price >= mp AND size >= ms THEN 'both' WHEN price >= mp THEN 'price' WHEN size >= ms THEN 'size'
            ELSE 'none' END AS quadrant FROM b, m
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    labels = ("both", "price", "size", "none")
    return settle(S.quadrant_label(brands(spark, folder).drop("spread"), "price", "size", labels=labels))


@query("spread_label", f"""
SELECT p_brand, CASE WHEN spread < 14 THEN 'narrow' WHEN spread < 14.5 THEN 'middle' WHEN spread >= 14.5 THEN 'wide' END
       AS label FROM ({BRANDS})
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    labels = ("narrow", "middle", "wide")
    return S.spread_labels(brands(spark, folder), "spread", (14.0, 14.5), labels, "label").select("p_brand", "label")


@query("segment_above_below", f"""
WITH b AS MATERIALIZED ({BRANDS}), m AS (SELECT avg(size) AS ms, avg(price) AS mp FROM b)
SELECT p_brand, round(price, 4) AS price, round(size, 4) AS size,
       CASE WHEN price > mp AND size < ms THEN 'hidden_gem' ELSE 'mass_appeal' END AS segment
FROM b, m WHERE (price > mp AND size < ms) OR (size > ms AND price BETWEEN mp - 1 AND mp + 1)
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.segment_above_below(brands(spark, folder).drop("spread"), "price", "size", margin=1.0))


HISTOGRAM = """
WITH b AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events),
h AS (SELECT least(CAST(floor((value - lo) / w) AS INTEGER), 19) AS bin, count(*) AS n FROM events, b
      WHERE value IS NOT NULL GROUP BY 1),
f AS (SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * w AS bin_low, lo + (g.bin + 1) * w AS bin_high,
             coalesce(n, 0) AS n, w
      FROM (SELECT unnest(range(20)) AS bin) g CROSS JOIN b LEFT JOIN h ON g.bin = h.bin)
"""


@query("histogram", f"""
{HISTOGRAM} SELECT bin, round(bin_low, 4) AS bin_low, round(bin_high, 4) AS bin_high, n FROM f
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.histogram(table(spark, folder, "events"), "value", 20))


@query("histogram_density", f"""
{HISTOGRAM} SELECT bin, round(bin_low, 4) AS bin_low, round(bin_high, 4) AS bin_high, n,
       round(n / (SELECT sum(n) FROM h) / w, 6) AS density FROM f
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    bins = S.histogram(table(spark, folder, "events"), "value", 20, density=True)
    return settle(bins, skip=("density",)).withColumn("density", F.round("density", 6))


@query("histogram_by", """
WITH b AS (SELECT event_type, min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events GROUP BY 1),
h AS (SELECT e.event_type, least(CAST(floor((value - lo) / w) AS INTEGER), 29) AS bin, count(*) AS n
      FROM events e JOIN b ON e.event_type = b.event_type WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT b.event_type, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 4) AS bin_low,
       round(lo + (g.bin + 1) * w, 4) AS bin_high, coalesce(n, 0) AS n
FROM b CROSS JOIN (SELECT unnest(range(30)) AS bin) g LEFT JOIN h ON h.event_type = b.event_type AND h.bin = g.bin
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.histogram(table(spark, folder, "events"), "value", 30, by=["event_type"]))


@query("histogram_bounds", """
SELECT CAST(g.bin AS INTEGER) AS bin, g.bin * 5.0 + 5 AS bin_low, g.bin * 5.0 + 10 AS bin_high, coalesce(n, 0) AS n
FROM (SELECT unnest(range(6)) AS bin) g LEFT JOIN (
  SELECT least(CAST(floor((l_quantity - 5) / 5) AS INTEGER), 5) AS bin, count(*) AS n FROM lineitem
  WHERE l_quantity BETWEEN 5 AND 35 GROUP BY 1) h ON g.bin = h.bin
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(S.histogram(table(spark, folder, "lineitem"), "l_quantity", 6, lo=5, hi=35))


@query("box_stats", """
WITH q AS (SELECT p_type, count(*) AS count, quantile_cont(p_retailprice, 0.25) AS q1,
                  quantile_cont(p_retailprice, 0.5) AS median, quantile_cont(p_retailprice, 0.75) AS q3
           FROM part GROUP BY p_type),
r AS (SELECT p.p_type, p_retailprice AS v, p_retailprice BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
      FROM part p JOIN q ON p.p_type = q.p_type)
SELECT q.p_type, count, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       min(v) FILTER (WHERE inside) AS whisker_low, max(v) FILTER (WHERE inside) AS whisker_high,
       count(*) FILTER (WHERE NOT inside) AS outliers
FROM q JOIN r ON q.p_type = r.p_type GROUP BY q.p_type, count, q1, median, q3
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(box_stats(table(spark, folder, "part"), ["p_type"], "p_retailprice"))


@query("box_stats_outliers", """
WITH q AS (SELECT event_type, count(*) AS count, quantile_cont(value, 0.25) AS q1,
                  quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
           FROM events GROUP BY event_type),
r AS (SELECT e.event_type, value AS v, value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
      FROM events e JOIN q ON e.event_type = q.event_type)
SELECT q.event_type, count, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       min(v) FILTER (WHERE inside) AS whisker_low, max(v) FILTER (WHERE inside) AS whisker_high,
       count(*) FILTER (WHERE NOT inside) AS outliers
FROM q JOIN r ON q.event_type = r.event_type GROUP BY q.event_type, count, q1, median, q3
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(box_stats(table(spark, folder, "events"), ["event_type"], "value"))


@query("ecdf", """
SELECT DISTINCT l_quantity, count(*) OVER (PARTITION BY l_quantity) AS n,
       round(cume_dist() OVER (ORDER BY l_quantity), 6) AS share FROM lineitem
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(ecdf(table(spark, folder, "lineitem"), "l_quantity"), 6)


@query("ecdf_prices", """
SELECT DISTINCT o_totalprice, count(*) OVER (PARTITION BY o_totalprice) AS n,
       round(cume_dist() OVER (ORDER BY o_totalprice), 7) AS share FROM orders
""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle(ecdf(table(spark, folder, "orders"), "o_totalprice"), 7)


# The p-value in SQL: the t density integrated by Simpson's rule.
T_TEST = """
WITH m AS (SELECT count(*) FILTER (WHERE {group} = {a}) AS n_a, avg({value}) FILTER (WHERE {group} = {a}) AS mean_a,
                  var_samp({value}) FILTER (WHERE {group} = {a}) AS var_a,
                  count(*) FILTER (WHERE {group} = {b}) AS n_b, avg({value}) FILTER (WHERE {group} = {b}) AS mean_b,
                  var_samp({value}) FILTER (WHERE {group} = {b}) AS var_b FROM ({rows})),
s AS (SELECT *, CAST(n_a + n_b - 2 AS DOUBLE) AS df,
             (mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2) * (1.0 / n_a + 1.0 / n_b))
             AS t FROM m),
i AS (SELECT sum((CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)
                 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
                 * pow(1 + pow(abs(t) * k / 2000, 2) / df, -(df + 1) / 2)) * max(abs(t)) / 2000 / 3 AS half
      FROM s, (SELECT unnest(range(2001)) AS k))
SELECT n_a, round(mean_a, 4) AS mean_a, round(var_a, 2) AS var_a, n_b, round(mean_b, 4) AS mean_b,
       round(var_b, 2) AS var_b, df, round(t, 4) AS t, round(1 - 2 * half, 4) AS p, 1 - 2 * half < 0.05 AS significant
FROM s, i
"""


def settle_t(result: DataFrame) -> DataFrame:
    spreads = ("var_a", "var_b")
    return settle(result, skip=spreads).withColumns({name: F.round(name, 2) for name in spreads})


@query("two_sample_t", T_TEST.format(rows=LABELLED, group="toxic", value="n_chars", a=0, b=1))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle_t(S.two_sample_t(labelled(spark, folder), "toxic", "n_chars", 0, 1))


@query("two_sample_t_statuses", T_TEST.format(
    rows="SELECT * FROM orders", group="o_orderstatus", value="o_totalprice", a="'F'", b="'O'"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return settle_t(S.two_sample_t(table(spark, folder, "orders"), "o_orderstatus", "o_totalprice", "F", "O"))

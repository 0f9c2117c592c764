"""Data-quality profiles: missing values, ranges, rules, keys, distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.functions.columns import percentage
from reelmill.operators.ranking import top_n, top_n_per_group


def null_count_columns(cols: list[str]) -> list[Column]:
    return [F.count_if(F.col(name).isNull()).alias(name) for name in cols]


def null_counts(df: DataFrame, cols: list[str] | None = None, long: bool = False) -> DataFrame:
    """Missing values of every column in one pass; one row, or one row per column."""
    cols = cols or df.columns
    counts = df.agg(*null_count_columns(cols))
    return counts.unpivot([], cols, "column_name", "nulls") if long else counts


def range_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    picks = [f(c).alias(f"{name}_{c}") for c in cols for f, name in ((F.min, "min"), (F.max, "max"))]
    return df.agg(*picks)


def rule_violations(df: DataFrame, rules: dict[str, Column], long: bool = False) -> DataFrame:
    """How many rows break each named rule, all rules in one pass."""
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations") if long else counts


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, rows beyond the first of their key. One shuffle of counts."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"),
    )


def distribution(df: DataFrame, col: str, n: int | None = None, drop_null_keys: bool = False) -> DataFrame:
    """Rows per value, most frequent first; optionally only the top n."""
    rows = df.filter(F.col(col).isNotNull()) if drop_null_keys else df
    counts = rows.groupBy(col).agg(F.count("*").alias("n"))
    if n is None:
        return counts.orderBy(F.desc("n"), F.col(col).asc_nulls_last())
    return top_n(counts, "n", n, tie=[col])


def distribution_share(df: DataFrame, col: str, drop_null_keys: bool = True) -> DataFrame:
    """Rows per value and their percentage of all rows."""
    rows = df.filter(F.col(col).isNotNull()) if drop_null_keys else df
    counts = rows.groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percentage(F.col("n"), total))


def distinct_values(
    df: DataFrame, col: str, by: list[str] | None = None, n: int | None = None, marker: str | None = None
) -> DataFrame:
    """Distinct present values, per group as a sorted array; ``n`` keeps the first ones in order."""
    rows = df.filter(F.col(col).isNotNull())
    if marker is not None:
        rows = rows.filter(F.col(col) != marker)
    values = rows.select(*(by or []), col).distinct()
    if not by:
        return values if n is None else top_n(values, col, n, desc=False)
    if n is not None:
        values = top_n_per_group(values, by, col, n, desc=False)
    return values.groupBy(*by).agg(F.sort_array(F.collect_list(col)).alias(col))


def quality_metrics(tables: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """One row per table: its rows and each metric's count, 0 where a table has no such metric."""
    metrics = list(dict.fromkeys(name for _, wanted in tables.values() for name in wanted))
    rows = [
        frame.agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("row_count"),
            *[
                (F.count_if(wanted[name]) if name in wanted else F.lit(0).cast("long")).alias(name)
                for name in metrics
            ],
        )
        for table, (frame, wanted) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def row_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with the number of rows of two frames, in one job. See ``write_counted`` for a write."""
    return before.agg(F.count("*").alias("rows_before")).withColumn(
        "rows_after", after.agg(F.count("*")).scalar()
    )

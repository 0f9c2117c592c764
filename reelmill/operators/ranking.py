"""Top-n lists, extremes per group, fixed orders and repeatable samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.operators.joins import semi_in_set


def _order(col: str, desc: bool, tie: list[str]) -> list[Column]:
    """Missing values last in either direction; ties broken by the named columns, ascending."""
    first = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_last()
    return [first, *[F.col(name).asc_nulls_last() for name in tie]]


def top_n(df: DataFrame, col: str, n: int, desc: bool = True, tie: list[str] | None = None) -> DataFrame:
    """The n largest or smallest rows: each task keeps its own n, one task merges them."""
    return df.orderBy(*_order(col, desc, tie or [])).limit(n)


def top_k_frequent(
    df: DataFrame, col: str, k: int, min_count: int = 1, drop_null_keys: bool = True
) -> DataFrame:
    """The k most frequent values with at least ``min_count`` rows, as ``(col, n)``."""
    rows = df.filter(F.col(col).isNotNull()) if drop_null_keys else df
    counts = rows.groupBy(col).agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    return top_n(counts, "n", k, tie=[col])


def keep_frequent(df: DataFrame, col: str, k: int, min_count: int = 1) -> DataFrame:
    """The rows of the k most frequent values. The set of k values is joined, never collected."""
    return semi_in_set(df, top_k_frequent(df, col, k, min_count).select(col), [col])


def arg_extreme(
    df: DataFrame, col: str, by: list[str] | None = None, tie: list[str] | None = None, largest: bool = True
) -> DataFrame:
    """The whole row with the largest or smallest value, per group; ties go to the smallest key.

    Any type that can be ordered will do. Each task keeps one row per group before the shuffle. Rows
    without a value are not candidates.
    """
    present = df.filter(F.col(col).isNotNull())
    return top_n_per_group(present, by, col, 1, largest, tie) if by else top_n(present, col, 1, largest, tie)


def arg_extremes(
    df: DataFrame, col: str, by: list[str], tie: list[str], names: tuple[str, str], out: str = "extreme"
) -> DataFrame:
    """Both whole rows, the one with the largest and the one with the smallest value."""
    both = [arg_extreme(df, col, by, tie, largest).select(F.lit(name).alias(out), "*")
            for name, largest in zip(names, (True, False), strict=True)]
    return both[0].unionByName(both[1])


def rank_rows(df: DataFrame, col: str, n: int, desc: bool = True, tie: list[str] | None = None) -> DataFrame:
    """Ranks 1..n over the n best rows. Only those n rows meet in the one task that numbers them."""
    best = top_n(df, col, n, desc, tie)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*_order(col, desc, tie or []))))


def top_n_per_group(
    df: DataFrame,
    by: list[str],
    col: str,
    n: int,
    desc: bool = True,
    tie: list[str] | None = None,
    rank: str | None = None,
) -> DataFrame:
    """The n best rows of each group.

    Spark cuts each group to n rows in every task before the shuffle (window group limit), so a hot
    group sends at most n rows per task to the task that ranks it.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*_order(col, desc, tie or [])))
    name = rank or "_place"
    best = df.withColumn(name, place).filter(F.col(name) <= n)
    return best if rank else best.drop(name)


def reorder_fill(df: DataFrame, key: str, values: list, fill: dict, position: str = "position") -> DataFrame:
    """One row per listed value in the listed order, with ``fill`` where the value does not occur."""
    kind = df.schema[key].dataType.simpleString()
    wanted = df.sparkSession.createDataFrame(
        [(value, place) for place, value in enumerate(values, 1)], f"`{key}` {kind}, `{position}` int"
    )
    return wanted.join(df, key, "left").na.fill(fill)


def sample_rows(df: DataFrame, n: int, seed: int, key: list[str]) -> DataFrame:
    """At most n rows, the same ones for any partitioning of the input.

    Rows get the MD5 of their key and the seed, joined by colons (a missing part is empty), and the n smallest win. A
    count per four leading hex digits finds the part of the range that holds n rows, so only about n rows reach the
    final sort instead of n rows from every task.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in key]
    hashed = df.withColumn("_hash", F.md5(F.concat_ws(":", *parts, F.lit(str(seed)))))
    slot = F.substring("_hash", 1, 4)
    slots = hashed.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy("slot"))
    last = (
        slots.withColumn("before", running - F.col("n"))
        .filter(F.col("before") < n)
        .agg(F.max("slot"))
        .scalar()
    )
    return hashed.filter(slot <= last).orderBy("_hash", *key).limit(n).drop("_hash")

"""Equi-joins by key.

No data side is forced to be broadcast: Spark broadcasts a side only when its size is known to be below
``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles both sides and splits hot keys
(``spark.sql.adaptive.skewJoin``). The one thing Spark cannot split is a hot key on the right side of a
left join; ``skewed=True`` spreads such keys over salts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inner_on_key(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    return left.join(right, on, "inner")


def left_on_key(
    left: DataFrame, right: DataFrame, on: str | list[str], skewed: bool = False, task_rows: int | None = None
) -> DataFrame:
    """Keeps every left row. ``skewed`` is for a right side of which one key may hold a large part: its rows are
    spread so that a task reads about ``task_rows`` of them."""
    keys = [on] if isinstance(on, str) else list(on)
    return _left_salted(left, right, keys, task_rows or TASK_ROWS) if skewed else left.join(right, keys, "left")


def left_on_composite(
    left: DataFrame, right: DataFrame, on: list[str], skewed: bool = False
) -> DataFrame:
    """Keeps every left row; all key columns have to match."""
    return left_on_key(left, right, on, skewed)


def left_renamed_keys(
    left: DataFrame, right: DataFrame, keys: dict[str, str], skewed: bool = False
) -> DataFrame:
    """Left join on keys named differently on each side; the right names do not appear in the result.

    A left row with several matches comes out several times.
    """
    aligned = right.withColumnsRenamed({theirs: ours for ours, theirs in keys.items()})
    return left_on_key(left, aligned, list(keys), skewed)


# A key is hot if it has more rows than one task should read. It gets a salt for each such portion.
TASK_ROWS = 1_000_000


def _left_salted(left: DataFrame, right: DataFrame, keys: list[str], task_rows: int) -> DataFrame:
    """Left join that spreads the right rows of a hot key over salts.

    Left rows of a hot key meet every salt. As a hot key has right rows, a left row that finds nothing
    under one salt is left out there and comes out under another; cold keys have one salt.
    """
    hot = heavy_keys(right.na.drop(subset=keys), keys, task_rows).select(*keys, F.ceil(F.col("_n") / task_rows).cast("int").alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    # The salt comes from the row's content, so that a task that runs again deals its rows as before.
    content = F.xxhash64(*[F.col(f"`{name}`") for name in right.columns])
    spread = right.join(hot, keys, "left").withColumn("_salt", F.pmod(content, salts).cast("int")).drop("_salts")
    met = left.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    joined = met.join(spread.withColumn("_match", F.lit(True)), [*keys, "_salt"], "left")
    return joined.filter((salts == 1) | F.col("_match").isNotNull()).drop("_salt", "_match", "_salts")


# Candidates for heavy keys, and the counters of the summary that finds them.
HEAVY, COUNTERS = 10_000, 100_000


def heavy_keys(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Keys with more than ``least`` rows, with their exact number of rows ``_n``; without a count of all keys.

    A summary of frequent key hashes has a bounded number of counters, so tasks send that much at most and nothing
    else. Only the rows of its candidates are then counted by key. A key that holds so small a part of all rows that it escapes
    the summary (less than some 4 in 100,000) holds no more of a shuffle than one task's share.
    """
    hashed = F.xxhash64(*keys)
    candidates = df.agg(F.explode(F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {HEAVY}, {COUNTERS})")).alias("c"))
    chosen = candidates.where(F.col("c.count") > least // 2).select(F.col("c.item").alias("_hash"))
    rows = df.select(*keys).withColumn("_hash", hashed).join(chosen, "_hash", "left_semi")
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > least)


def chain_join(base: DataFrame, steps: list[tuple[DataFrame, str | list[str], str]]) -> DataFrame:
    """Joins in the given order: ``(frame, key, how)``."""
    joined = base
    for frame, on, how in steps:
        joined = joined.join(frame, on, how)
    return joined


def lookup_default(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, default: str, out: str
) -> DataFrame:
    """The name of an id, or the default. One name per id (the largest), so no row is multiplied."""
    names = dim.groupBy(F.col(dim_key).alias(key)).agg(F.max(value).alias(out))
    return df.join(names, key, "left").withColumn(out, F.coalesce(out, F.lit(default)))


def semi_in_set(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in the set; the set stays a DataFrame."""
    return df.join(keys, on, "left_semi")


def orphan_keys(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows that name a parent which does not exist. A missing name is no orphan."""
    parents = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(parents, fk, "left_anti")


def detail_lookup(keys: DataFrame, facts: DataFrame, on: str, values: list[str]) -> DataFrame:
    """For each chosen key the sorted distinct values of some columns, in one job for all keys; a key without details has
    empty arrays.

    Copies are removed before any array is built, so a hot key sends its distinct values only.
    """
    chosen = facts.join(keys.select(on), on, "left_semi")
    texts = chosen.select(on, *[F.col(v).cast("string").alias(v) for v in values])
    pairs = texts.unpivot([on], values, "_field", "_value").filter(F.col("_value").isNotNull()).distinct()
    found = pairs.groupBy(on).agg(*[
        F.sort_array(F.collect_set(F.when(F.col("_field") == v, F.col("_value")))).alias(v) for v in values
    ])
    none = F.expr("cast(array() as array<string>)")
    return keys.select(on).distinct().join(found, on, "left").withColumns({v: F.coalesce(v, none) for v in values})

"""Global row numbers and chunks, without sorting all rows in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.session import materialize

# Spark numbers rows as (partition << 33) + place in the partition.
_PLACE_BITS = 33


def number_rows(df: DataFrame, order_cols: list[str], out: str = "row_number") -> DataFrame:
    """Row numbers 1..n over the whole table in the given order.

    Rows are range-partitioned and sorted within each range, numbered there, frozen in the shared
    folder (range bounds come from a sample), and shifted by the rows of the ranges ahead, which is one
    small row per range. Ties are ordered by a hash of the whole row, and copies of a row are counted and
    numbered, so that many copies spread over several ranges and a task that runs again finds them as before.
    """
    names = df.columns
    order = [*order_cols, "_tie", "_copy"]
    ranged = _numbered_copies(df).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.select(*names, F.monotonically_increasing_id().alias("_id")))
    placed = placed.withColumns({
        "_range": F.shiftright("_id", _PLACE_BITS),
        "_place": F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
    })
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    running = F.sum("_size").over(Window.orderBy("_range"))
    offsets = sizes.select("_range", (running - F.col("_size")).alias("_ahead"))
    numbered = placed.join(offsets, "_range").withColumn(out, F.col("_ahead") + F.col("_place") + 1)
    return numbered.select(*names, out)


def _numbered_copies(df: DataFrame) -> DataFrame:
    """Rows with ``_tie``, a hash of the row, and ``_copy``, a number from 0 for rows that are equal in all columns.

    Hashes are counted first, eight bytes a row and combined before the shuffle. Only rows whose hash occurs again are grouped
    as a whole, and each group is laid out again as often as it was found.
    """
    names = df.columns
    tied = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{name}`") for name in names]))
    again = materialize(tied.groupBy("_tie").agg(F.count("*").alias("_n")).where("_n > 1").select("_tie"))
    first = F.lit(0).cast("long")
    if again.isEmpty():
        return tied.withColumn("_copy", first)
    counted = tied.join(again, "_tie", "left_semi").groupBy(*names, "_tie").agg(F.count("*").alias("_n"))
    copies = counted.withColumn("_copy", F.explode(F.sequence(first, F.col("_n") - 1))).drop("_n")
    return tied.join(again, "_tie", "left_anti").withColumn("_copy", first).unionByName(copies)


def assign_chunks(df: DataFrame, order_cols: list[str], n: int) -> DataFrame:
    """Rows with ``row_number`` and ``chunk``; every chunk but the last has n rows."""
    chunk = F.floor((F.col("row_number") - 1) / n) + 1
    return number_rows(df, order_cols).withColumn("chunk", chunk)


def chunk_manifest(chunked: DataFrame) -> DataFrame:
    """One row per chunk: rows, first and last row, counted from 0."""
    return chunked.groupBy("chunk").agg(
        F.count("*").alias("rows"),
        (F.min("row_number") - 1).alias("start_row"),
        (F.max("row_number") - 1).alias("end_row"),
    )


def total_manifest(datasets: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset, by name, and a row ``total`` over all of them: rows, chunks and mean chunk size."""
    each = [dataset_manifest(chunked, name).drop("columns") for name, chunked in datasets.items()]
    rows = reduce(DataFrame.unionByName, each)
    total = rows.agg(
        F.lit("total").alias("dataset"), F.sum("total_rows").alias("total_rows"), F.sum("chunks").alias("chunks"),
        F.floor(F.sum("total_rows") / F.sum("chunks")).alias("mean_rows"),
    )
    return rows.unionByName(total)


def dataset_manifest(chunked: DataFrame, dataset: str) -> DataFrame:
    """One row per dataset: rows, columns, chunks, mean chunk size (whole rows)."""
    columns = len(chunked.columns) - 2
    chunks = chunked.groupBy("chunk").agg(F.count("*").alias("rows"))
    return chunks.agg(
        F.lit(dataset).alias("dataset"),
        F.sum("rows").cast("long").alias("total_rows"),
        F.lit(columns).alias("columns"),
        F.count("*").alias("chunks"),
        F.floor(F.sum("rows") / F.count("*")).alias("mean_rows"),
    )

"""Projections, casts and filters over named columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmill.functions import columns as C

WHOLE = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast columns; what cannot be cast becomes NULL, where a plain cast would fail the job (ANSI)."""
    def cast(name: str, kind: str) -> Column:
        text = isinstance(df.schema[name].dataType, T.StringType)
        if kind == "boolean":
            return C.boolean_flag(F.col(name))
        if text and kind in WHOLE:
            return C.whole_number(F.col(name), kind)
        return F.col(name).try_cast(kind)

    return df.withColumns({name: cast(name, kind) for name, kind in kinds.items()})


def to_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).try_cast("double") for name in cols})


def flag_to_boolean(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, C.boolean_flag(F.col(col)))


def flag_to_int(df: DataFrame, col: str) -> DataFrame:
    """A flag as 0 or 1, from text or from a boolean."""
    return df.withColumn(col, F.col(col).try_cast("int"))


def strip_list_markup(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, C.without_markup(F.col(col)))


def null_marker_filter(df: DataFrame, cols: list[str], marker: str = C.NULL_MARKER) -> DataFrame:
    """Rows where every column is present and is not the null marker."""
    return df.filter(C.all_of([F.col(c).isNotNull() & (F.col(c) != marker) for c in cols]))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def range_filter(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Rows inside every closed range; None leaves that end open."""
    parts = []
    for name, (low, high) in ranges.items():
        if low is not None:
            parts.append(F.col(name) >= low)
        if high is not None:
            parts.append(F.col(name) <= high)
    return df.filter(C.all_of(parts))


def equals_filter(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def label_map(df: DataFrame, col: str, mapping: dict, out: str, default=None) -> DataFrame:
    return df.withColumn(out, C.labelled(F.col(col), mapping, default))


def bucket_left_closed(df: DataFrame, col: str, edges: list, labels: list[str], out: str) -> DataFrame:
    return df.withColumn(out, C.left_closed_bucket(F.col(col), edges, labels))


def bucket_right_closed(df: DataFrame, col: str, edges: list, labels: list[str], out: str) -> DataFrame:
    return df.withColumn(out, C.right_closed_bucket(F.col(col), edges, labels))


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


def round_stats(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    """Rounding for display: half away from zero. Rank before rounding, not after."""
    return df.withColumns({name: F.round(name, digits) for name in cols})


def sort_rows(df: DataFrame, cols: list[str], desc: bool = False) -> DataFrame:
    """Sorted rows, missing values last either way."""
    order = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c in cols]
    return df.orderBy(*order)


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()

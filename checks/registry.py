"""Registration of queries, table access and a settled form of results for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmill.sources.readers import scan_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under an operator's name, with its SQL if there is one."""
    def keep(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            # Dates are compared with an engine that knows no session time zone.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return keep


def table(spark: SparkSession, folder: str, name: str, *cols: str) -> DataFrame:
    return scan_parquet(spark, f"{folder}/{name}.parquet", list(cols) or None)


def as_text(df: DataFrame, *names: str) -> DataFrame:
    """Dates and whole numbers that may be missing as text, which every engine hands over alike."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def settle(df: DataFrame, digits: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded and arrays as text, so that results can be compared across engines."""
    cols = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if field.name not in skip and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(col, digits)
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(F.transform(col, lambda x: x.cast("string")), "|")
        cols.append(col.alias(field.name))
    return df.select(*cols)

"""Exact order statistics that never sort or hold an unbounded group in one task, by selection.

Spark's ``percentile`` keeps all distinct values of a group in the memory of one task, and a window over a group sorts it in
one task. Here every group gets a histogram over buckets that are the same for all numbers (a power of two in 8 parts, as
the leading bits of a double would cut it). Its sums tell which bucket holds a wanted rank. Buckets that still hold
more than ``TASK_ROWS`` rows are cut into cells between their smallest and their largest value, as often as it takes. Only the
values inside the last intervals are counted and put in order. Histograms combine before they are shuffled, results are
exact, no row is left out, and groups of every size go the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from reelmill.functions.columns import all_of
from reelmill.session import materialize

STATS = ("count", "sum", "mean", "median", "std", "min", "max")

TASK_ROWS = 1_000_000  # rows of one interval that a task puts in order
CELLS = 4096  # parts of an interval that has more
_PARTS = 8  # buckets of a power of two
_LARGEST = 1.7976931348623157e308
_TOP = 2100 * _PARTS  # the bucket of infinity


def _bucket(value: Column) -> Column:
    """A whole number that never falls as the value rises. NaN is above everything, as it is for Spark."""
    size = F.least(F.abs(value), F.lit(_LARGEST))
    power = F.floor(F.log2(size))
    part = F.floor((size / F.pow(F.lit(2.0), power) - 1) * _PARTS)
    place = (power + 1075) * _PARTS + F.greatest(F.least(part, F.lit(_PARTS - 1)), F.lit(0)) + 1
    place = F.when(F.isnan(value), _TOP + 1).when(F.abs(value) > _LARGEST, _TOP).otherwise(place)
    return F.when(value == 0, 0).when(value < 0, -place).otherwise(place).cast("int")


def _holds(ranks: list[Column]) -> Column:
    """Whether an interval holds one of the ranks, counted from 0."""
    found = F.lit(False)
    for rank in ranks:
        found = found | ((F.col("_ahead") <= rank) & (rank < F.col("_ahead") + F.col("_rows")))
    return found


def _ranks(p: float) -> tuple[Column, Column, Column]:
    """Place of a quantile in its group, and the ranks below and above it."""
    place = (F.col("_total") - 1) * F.lit(p)
    return place, F.floor(place), F.ceil(place)


def intervals(values: DataFrame, group: list[str], wanted: Column) -> DataFrame:
    """Intervals of values, per group, that hold what is wanted and few enough rows for one task (or a single value).

    ``values`` has the group, ``_value``, ``_weight`` (rows with this value) and ``_bucket``. A result row is an interval
    ``_low`` to ``_high`` within one ``_bucket``, with the rows in it (``_rows``), ahead of it (``_ahead``) and in all
    (``_total``). ``wanted`` is a condition on these three. Rows of one group are as many as there are buckets at most before
    anything is cut.
    """
    sums = [F.sum("_weight").alias("_rows"), F.min("_value").alias("_low"), F.max("_value").alias("_high")]
    whole = Window.partitionBy(*group)
    found = values.groupBy(*group, "_bucket").agg(*sums)
    found = found.withColumns({
        "_ahead": F.sum("_rows").over(whole.orderBy("_bucket")) - F.col("_rows"), "_total": F.sum("_rows").over(whole),
    })
    names = [*group, "_bucket", "_low", "_high", "_rows", "_ahead", "_total"]
    large = (F.col("_low") < F.col("_high")) & (F.col("_rows") > TASK_ROWS)
    found, left = _stored(found.where(wanted).select(*names), large)
    while left:
        parents = found.where(large).withColumnsRenamed({"_low": "_from", "_high": "_to", "_ahead": "_base"}).drop("_rows")
        inside = values.join(parents, [*group, "_bucket"]).where(F.col("_value").between(F.col("_from"), F.col("_to")))
        cell = F.floor((F.col("_value") - F.col("_from")) / (F.col("_to") - F.col("_from")) * CELLS)
        key = [*group, "_bucket", "_from", "_base", "_total"]
        parts = inside.groupBy(*key, F.least(cell, F.lit(CELLS - 1)).alias("_cell")).agg(*sums)
        order = Window.partitionBy(*key).orderBy("_cell")
        parts = parts.withColumn("_ahead", F.col("_base") + F.sum("_rows").over(order) - F.col("_rows"))
        found, left = _stored(found.where(~large).unionByName(parts.where(wanted).select(*names)), large)
    return found


def _stored(rows: DataFrame, counted: Column) -> tuple[DataFrame, int]:
    """The rows as a stored table, and how many of them meet a condition, counted while they are written."""
    seen = Observation()
    table = materialize(rows.observe(seen, F.count_if(counted).alias("n")))
    return table, seen.get["n"]


def _placed(values: DataFrame, group: list[str], found: DataFrame) -> DataFrame:
    """Each distinct value inside the intervals with ``_weight``, ``_before`` (rows of the group ahead of it) and ``_total``."""
    inside = values.join(found, [*group, "_bucket"]).where(F.col("_value").between(F.col("_low"), F.col("_high")))
    key = [*group, "_bucket", "_low", "_ahead", "_total"]
    counts = inside.groupBy(*key, "_value").agg(F.sum("_weight").alias("_weight"))
    order = Window.partitionBy(*key).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("_ahead") + F.sum("_weight").over(order) - F.col("_weight")
    return counts.select(*group, "_value", "_weight", before.alias("_before"), "_total")


@dataclass
class OrderedValues:
    """Numeric columns by group; ``rows`` has the group columns and the numbers as doubles, stored in the shared folder."""

    rows: DataFrame
    by: list[str]
    cols: list[str]

    @property
    def group(self) -> list[str]:
        return [*self.by, "_field"]

    def _long(self) -> DataFrame:
        """One row for each number: the group, ``_field`` (which column) and ``_value``."""
        if len(self.cols) == 1:
            return self.rows.select(*self.by, F.lit(self.cols[0]).alias("_field"), F.col(f"`{self.cols[0]}`").alias("_value"))
        return self.rows.unpivot(self.by, self.cols, "_field", "_value")

    def quantiles(self, probs: dict[str, float]) -> DataFrame:
        """Per group and column with a value: the named quantiles, interpolated between neighbours."""
        present = self._long().where(F.col("_value").isNotNull())
        values = present.withColumns({"_weight": F.lit(1).cast("long"), "_bucket": _bucket(F.col("_value"))})
        found = intervals(values, self.group, _holds([r for p in probs.values() for r in _ranks(p)[1:]]))
        return _placed(values, self.group, found).groupBy(*self.group).agg(*[_quantile(p).alias(n) for n, p in probs.items()])

    def statistics(self, probs: dict[str, float] | None = None) -> DataFrame:
        """Per group and column: ``count, sum, mean, std, min, max`` and the named quantiles. The spread is NULL for fewer than
        two values."""
        value = F.col("_value")
        plain = self._long().groupBy(*self.group).agg(
            F.count(value).alias("count"), F.sum(value).alias("sum"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"), F.max(value).alias("max"),
        )
        return plain.join(self.quantiles(probs), self.group, "left") if probs else plain

    def wide(self, probs: dict[str, float]) -> DataFrame:
        """One row per group with a value, with columns ``{col}_{name}`` for the named quantiles."""
        picks = [F.max(F.when(F.col("_field") == col, F.col(name))).alias(f"{col}_{name}") for col in self.cols for name in probs]
        return self.quantiles(probs).groupBy(*self.by).agg(*picks)

    def box(self) -> DataFrame:
        """Quartiles, whiskers and outliers of a single column."""
        quartiles = self.statistics({"q1": 0.25, "median": 0.5, "q3": 0.75}).select(*self.by, "count", "q1", "median", "q3")
        reach = (F.col("q3") - F.col("q1")) * 1.5
        value = F.col(f"`{self.cols[0]}`")
        inside = value.between(F.col("q1") - reach, F.col("q3") + reach)
        # A row for each group on the right; its figures are part of the key, so that no second join fetches them.
        return self.rows.join(quartiles, self.by).groupBy(*self.by, "count", "q1", "median", "q3").agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )


def _quantile(p: float) -> Column:
    """The quantile of a group from the positions of its values."""
    place, low, high = _ranks(p)
    before, after = F.col("_before"), F.col("_before") + F.col("_weight")
    at_low = F.max(F.when((before <= low) & (low < after), F.col("_value")))
    at_high = F.max(F.when((before <= high) & (high < after), F.col("_value")))
    share = F.max(place - low)
    return at_low + (at_high - at_low) * share


def order_values(df: DataFrame, by: list[str], cols: list[str]) -> OrderedValues:
    """Store the group columns and numbers of a frame, so that every step that follows sees the same ones.

    Rows with a missing group key are left out. Without groups, all rows are one group named ``_all``.
    """
    present = all_of([F.col(name).isNotNull() for name in by])
    numbers = df.filter(present) if by else df.withColumn("_all", F.lit(1))
    keys = by or ["_all"]
    return OrderedValues(materialize(numbers.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])), keys, cols)


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """Each distinct value with the share of rows at or below it. Distinct values are counted and stored once."""
    counts = df.select(F.col(col).cast("double").alias("_value")).where(F.col("_value").isNotNull()).groupBy("_value").agg(
        F.count("*").alias("_weight"))
    values = materialize(counts.withColumns({"_bucket": _bucket(F.col("_value")), "_all": F.lit(1)}))
    placed = _placed(values, ["_all"], intervals(values, ["_all"], F.lit(True)))
    share = (F.col("_before") + F.col("_weight")) / F.col("_total")
    return placed.select(F.col("_value").alias(col), F.col("_weight").alias("n"), share.alias("share"))


def box_stats(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Quartiles, whiskers (the outermost values within 1.5 IQR) and the number of outliers per group."""
    return order_values(df, by, [col]).box()

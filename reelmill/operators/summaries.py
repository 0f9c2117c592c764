"""Grouped statistics, cross tables, histograms and a two-sample test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.functions.columns import all_of, left_closed_bucket, percentage
from reelmill.functions.student import p_value
from reelmill.operators.ordered import STATS, OrderedValues, order_values
from reelmill.session import materialize


def _plain(stat: str, col: str) -> Column:
    """Statistics that Spark combines before the shuffle; NULL keys and NULL values as in group-bys."""
    aggregates = {
        "count": F.count, "sum": F.sum, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    }
    return aggregates[stat](col)


def multi_summary(
    df: DataFrame, by: list[str], wanted: dict[str, list[str]], drop_null_keys: bool = True
) -> DataFrame:
    """Chosen statistics of several columns per group, named ``{col}_{stat}``.

    All but medians come from one hash aggregate with a partial step, in the column's own type. Medians are selected exactly,
    from a stored copy of the columns in question; groups with a missing key are then left out.
    """
    unknown = {s for stats in wanted.values() for s in stats} - set(STATS)
    if unknown:
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    medians = {col: ["median"] for col, stats in wanted.items() if "median" in stats}
    rows = df.na.drop(subset=by) if by and (drop_null_keys or medians) else df
    picks = [_plain(s, col).alias(f"{col}_{s}") for col, stats in wanted.items() for s in stats if s != "median"]
    if not medians:
        return rows.groupBy(*by).agg(*picks)
    # Without groups there is one row on either side.
    keys = by or ["_all"]
    rows = (rows if by else rows.withColumn("_all", F.lit(1))).select(*keys, *[F.col(c) for c in wanted])
    rows = materialize(rows)
    numbers = rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in medians])
    found = OrderedValues(numbers, keys, list(medians)).wide({"median": 0.5})
    middles = rows.groupBy(*keys).agg(*picks or [F.count("*")]).join(found, keys, "left")
    return middles.select(*by, *[f"{col}_{s}" for col, stats in wanted.items() for s in stats])


def grouped_summary(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Count, mean, median, standard deviation, minimum and maximum per group."""
    stats = ["count", "mean", "median", "std", "min", "max"]
    return multi_summary(df, by, {col: stats}).withColumnsRenamed({f"{col}_{s}": s for s in stats})


def describe_column(df: DataFrame, col: str) -> DataFrame:
    """One row: count, mean, standard deviation, minimum, quartiles, maximum."""
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    row = order_values(df, [], [col]).statistics(quartiles)
    return row.select("count", "mean", "std", "min", "q1", "median", "q3", "max")


def grouped_mean(df: DataFrame, by: list[str], col: str, drop_null_keys: bool = True) -> DataFrame:
    summary = multi_summary(df, by, {col: ["mean"]}, drop_null_keys)
    return summary.withColumnRenamed(f"{col}_mean", "mean")


def grouped_mean_std(df: DataFrame, by: list[str], col: str, drop_null_keys: bool = True) -> DataFrame:
    summary = multi_summary(df, by, {col: ["mean", "std"]}, drop_null_keys)
    return summary.withColumnsRenamed({f"{col}_mean": "mean", f"{col}_std": "std"})


def flag_rate(df: DataFrame, by: list[str], flag: str, drop_null_keys: bool = True) -> DataFrame:
    """Per group the number of rows with a flag, how many are set, the share and the percentage."""
    rows = df.na.drop(subset=by) if by and drop_null_keys else df
    counts = rows.groupBy(*by).agg(F.count(flag).alias("n"), F.sum(flag).cast("long").alias("flagged"))
    return counts.select(
        *by, "n", "flagged",
        F.try_divide(F.col("flagged").cast("double"), F.col("n").cast("double")).alias("share"),
        percentage(F.col("flagged"), F.col("n")).alias("pct"),
    )


def crosstab(
    df: DataFrame,
    row: str,
    col: str,
    values: list,
    names: list[str] | None = None,
    total: str | None = None,
    normalize: str | None = None,
) -> DataFrame:
    """Counts of ``row`` by ``col`` with a fixed column order and 0 for empty cells.

    The values are given, so this is one aggregate and no job has to find them. ``normalize="row"``
    turns counts into percentages of the row, ``total`` names a column with the row total. Rows with a
    missing row or column key do not count.
    """
    names = names or [str(v) for v in values]
    kept = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    cells = kept.groupBy(row).agg(
        *[F.count_if(F.col(col) == F.lit(v)).alias(name) for v, name in zip(values, names)]
    )
    row_total = sum((F.col(name) for name in names), F.lit(0).cast("long"))
    if normalize == "row":
        table = cells.select(row, *[percentage(F.col(name), row_total).alias(name) for name in names])
        return table
    return cells.withColumn(total, row_total) if total else cells


def crosstab_row_pct(df: DataFrame, row: str, col: str, values: list, names: list[str] | None = None) -> DataFrame:
    return crosstab(df, row, col, values, names, normalize="row")


def min_support(summary: DataFrame, least: dict[str, float]) -> DataFrame:
    """Groups whose statistics reach every given minimum."""
    kept = summary
    for name, bound in least.items():
        kept = kept.filter(F.col(name) >= bound)
    return kept


def split_totals(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """One row: total, and the count and percentage of rows for each named condition."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(name) for name, c in flags.items()])
    return counts.select("*", *[percentage(F.col(name), F.col("total")).alias(f"{name}_pct") for name in flags])


def thresholds(df: DataFrame, cols: list[str], how: str = "median") -> DataFrame:
    """One row with the median or the mean of each column."""
    if how == "median":
        middles = order_values(df, [], cols).wide({"median": 0.5})
        return middles.agg(*[F.max(f"{c}_median").alias(c) for c in cols])
    if how == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in cols])
    raise ValueError("how must be 'median' or 'mean'")


def _one_row(frame: DataFrame) -> Column:
    """A one-row frame as a struct that can stand in any expression (a scalar subquery)."""
    return frame.agg(F.first(F.struct(*frame.columns))).scalar()


# Names of the four quadrants, high/high first, then by falling first measure.
QUADRANTS = (
    "High Quality & High Popularity",
    "High Quality & Low Popularity",
    "Low Quality & High Popularity",
    "Low Quality & Low Popularity",
)


def quadrant_label(
    df: DataFrame, x: str, y: str, out: str = "quadrant", labels: tuple[str, str, str, str] = QUADRANTS
) -> DataFrame:
    """Four labels by whether two measures reach their medians over all rows.

    The rows are frozen first: sums of doubles may differ in the last digit between two evaluations,
    and the row that is the median has to meet itself.
    """
    df = materialize(df)
    middle = _one_row(thresholds(df, [x, y], "median"))
    high_x, high_y = F.col(x) >= middle[x], F.col(y) >= middle[y]
    label = (
        F.when(high_x & high_y, labels[0])
        .when(high_x & ~high_y, labels[1])
        .when(~high_x & high_y, labels[2])
        .when(~high_x & ~high_y, labels[3])
    )
    return df.withColumn(out, label)


# Fixed value: how far from the mean rating a group with mass appeal may be.
APPEAL_MARGIN = 0.2


def segment_above_below(df: DataFrame, quality: str, reach: str, margin: float = APPEAL_MARGIN) -> DataFrame:
    """Rows that stand out against the mean over all rows, with their segment.

    ``hidden_gem``: quality above the mean, reach below it. ``mass_appeal``: reach above the mean,
    quality within ``margin`` of it. The rows are frozen first, as for the quadrants.
    """
    df = materialize(df)
    mean = _one_row(thresholds(df, [quality, reach], "mean"))
    near = F.col(quality).between(mean[quality] - margin, mean[quality] + margin)
    segment = (
        F.when((F.col(quality) > mean[quality]) & (F.col(reach) < mean[reach]), "hidden_gem")
        .when((F.col(reach) > mean[reach]) & near, "mass_appeal")
    )
    return df.withColumn("segment", segment).filter(F.col("segment").isNotNull())


def spread_labels(df: DataFrame, col: str, cuts: tuple[float, float], labels: tuple[str, str, str], out: str) -> DataFrame:
    return df.withColumn(out, left_closed_bucket(F.col(col), list(cuts), list(labels)))


def histogram(
    df: DataFrame,
    col: str,
    bins: int,
    by: list[str] | None = None,
    lo: float | None = None,
    hi: float | None = None,
    density: bool = False,
) -> DataFrame:
    """Counts in equal-width bins, empty bins included; the last bin holds its upper edge.

    Without ``lo`` and ``hi`` each group spans its own minimum to maximum. Values outside given bounds
    do not count. Bounds that are the same for all rows stand in the expression, so raw rows are
    binned where they are read and only bins are shuffled. Bounds per group, one row each, are found
    first and joined to the raw rows, and bins are again combined before they are shuffled.
    """
    by = by or []
    rows = df.na.drop(subset=[*by, col]).select(*by, F.col(col).cast("double").alias("_value"))
    low = F.lit(None if lo is None else float(lo)).cast("double")
    high = F.lit(None if hi is None else float(hi)).cast("double")
    fixed = lo is not None and hi is not None
    if fixed or not by:
        if not fixed:
            ends = rows.agg(F.struct(F.min("_value").alias("low"), F.max("_value").alias("high"))).scalar()
            low, high = F.coalesce(low, ends["low"]), F.coalesce(high, ends["high"])
        edges = _edges(low, high, bins)
        placed = rows.select(*by, "_value", F.lit(1).cast("long").alias("_rows"), *edges)
    else:
        least, most = F.coalesce(low, F.min("_value")), F.coalesce(high, F.max("_value"))
        ends = rows.groupBy(*by).agg(least.alias("_low"), most.alias("_high"))
        bounds = materialize(ends.select(*by, *_edges(F.col("_low"), F.col("_high"), bins)))
        placed = rows.withColumn("_rows", F.lit(1).cast("long")).join(bounds, by)
    # Bounds that were found hold all values; only given bounds can leave some out.
    inside = all_of(
        ([F.col("_value") >= F.col("_lo")] if lo is not None else [])
        + ([F.col("_value") <= F.col("_hi")] if hi is not None else [])
    )
    place = F.floor((F.col("_value") - F.col("_lo")) / F.col("_width")).cast("int")
    place = F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0))
    filled = placed.groupBy(*by, F.when(inside, place).alias("bin")).agg(F.sum("_rows").alias("n"))
    if fixed or not by:
        # Groups without a row inside the bounds are known from their rows outside.
        groups = filled.select(*by).distinct() if by else df.sparkSession.range(1).select()
        bounds = groups.select(*by, *edges).filter(F.col("_lo").isNotNull())
    frame = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    table = frame.join(filled, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_low"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("bin_high"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        "_width",
    )
    if density:
        # At most ``bins`` rows per group.
        total = F.sum("n").over(Window.partitionBy(*by))
        table = table.withColumn("density", F.try_divide(F.col("n"), total * F.col("_width")))
    return table.drop("_width")


def _edges(low: Column, high: Column, bins: int) -> list[Column]:
    """Lower end, upper end and bin width; a single value gets a range of one around it."""
    single = low == high
    lo, hi = F.when(single, low - 0.5).otherwise(low), F.when(single, high + 0.5).otherwise(high)
    return [lo.alias("_lo"), hi.alias("_hi"), ((hi - lo) / bins).alias("_width")]


def two_sample_t(df: DataFrame, group: str, value: str, a, b, alpha: float = 0.05) -> DataFrame:
    """Student's t with pooled variance between two groups: one row with t, df, p and significance.

    Size, mean and variance of both groups come from one aggregate over all rows.
    """
    first, second = (F.when(F.col(group) == F.lit(g), F.col(value)) for g in (a, b))
    moments = df.agg(
        F.count(first).alias("n_a"), F.avg(first).alias("mean_a"), F.var_samp(first).alias("var_a"),
        F.count(second).alias("n_b"), F.avg(second).alias("mean_b"), F.var_samp(second).alias("var_b"),
    )
    free = F.col("n_a") + F.col("n_b") - 2
    squares = (F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")
    pooled = F.try_divide(squares, free)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), F.col("n_a")) + F.try_divide(F.lit(1.0), F.col("n_b"))))
    tested = moments.select(
        "*", free.cast("double").alias("df"),
        F.try_divide(F.col("mean_a") - F.col("mean_b"), error).alias("t"),
    )
    return tested.withColumn("p", p_value("t", "df")).withColumn("significant", F.col("p") < alpha)

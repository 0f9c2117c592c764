"""Lists in text form: to one row per element, and back to arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.functions.columns import NULL_MARKER, split_to_array, text_trim
from reelmill.operators.ranking import top_n, top_n_per_group

# Texts that stand for no list, in the curation jobs and in the people rankings.
NO_LIST = ("",)
NO_PEOPLE = (NULL_MARKER,)


def explode_list(
    df: DataFrame,
    keys: list[str],
    col: str,
    out: str,
    sep: str = ",",
    trim: bool = False,
    drop_empty: bool = False,
    skip: tuple[str, ...] = NO_LIST,
) -> DataFrame:
    """One row per list element with the key columns kept.

    NULL and the texts in ``skip`` give no row; that filter comes before the explode, so that it reaches
    the scan. Narrow: no shuffle.
    """
    present = F.col(col).isNotNull()
    if skip:
        present = present & ~F.col(col).isin(*skip)
    rows = df.filter(present).select(*keys, F.explode(split_to_array(F.col(col), sep)).alias(out))
    # After the explode these are plain expressions in generated code; inside it they would be lambdas.
    if trim:
        rows = rows.withColumn(out, text_trim(F.col(out)))
    return rows.filter(F.col(out) != "") if drop_empty else rows


def attach_list(
    parent: DataFrame,
    children: dict[str, tuple[DataFrame, list[str], str]],
    empty: str = "null",
    distinct: bool = False,
) -> DataFrame:
    """Child rows back to one sorted array per parent: ``{array name: (child, keys, value)}``.

    Each child is grouped on its own before it is joined, so two children of one parent do not
    multiply each other. ``empty`` is ``"null"`` or ``"array"``. An array is one field of one row and
    so has to fit in memory; that is the shape of the result, not of the plan.
    """
    if empty not in ("null", "array"):
        raise ValueError("empty must be 'null' or 'array'")
    joined = parent
    for name, (child, keys, value) in children.items():
        rows = child.filter(F.col(value).isNotNull()).select(*keys, value)
        if distinct:
            rows = rows.distinct()
        arrays = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name))
        joined = joined.join(arrays, keys, "left")
        if empty == "array":
            kind = arrays.schema[name].dataType
            joined = joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))
    return joined


def element_frequencies(
    df: DataFrame,
    col: str,
    n: int | None = None,
    by: list[str] | None = None,
    sep: str = ",",
    out: str = "element",
    skip: tuple[str, ...] = ("", NULL_MARKER),
) -> DataFrame:
    """How often each element occurs, overall or per group, and the ``n`` most frequent ones.

    Counted with a partial aggregate before the shuffle, so a hot element costs one row per task.
    """
    by = by or []
    elements = explode_list(df, by, col, out, sep, trim=True, drop_empty=True, skip=skip)
    counts = elements.groupBy(*by, out).agg(F.count("*").alias("n"))
    if n is None:
        return counts
    if by:
        return top_n_per_group(counts, by, "n", n, tie=[out])
    return top_n(counts, "n", n, tie=[out])


def format_counts(
    df: DataFrame, by: list[str], element: str, count: str, n: int, out: str = "summary"
) -> DataFrame:
    """``"Drama(3), Comedy(1)"``: the ``n`` most frequent elements of each group as one text."""
    best = top_n_per_group(df, by, count, n, tie=[element])
    entries = F.sort_array(F.collect_list(F.struct((-F.col(count)).alias("o"), F.col(element).alias("e"))))
    texts = F.transform(entries, lambda x: F.concat(x["e"], F.lit("("), (-x["o"]).cast("string"), F.lit(")")))
    return best.groupBy(*by).agg(F.array_join(texts, ", ").alias(out))

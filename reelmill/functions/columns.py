"""Column in, Column out. Nothing here is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a dump writes for a missing field.
NULL_MARKER = "\\N"

# Fixed value: the blanks that list elements are stripped of.
BLANKS = " \t\n\r\x0b\x0c"


def whole_number(text: Column, kind: str = "int") -> Column:
    """Text to a whole number; ``12.7`` is cut to 12 and anything else that is no number gives NULL.

    The pattern keeps bad text away from the cast, which would raise and catch an error for each.
    """
    digits = F.substring_index(text, ".", 1).try_cast(kind)
    return F.when(text.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$"), digits)


def boolean_flag(flag: Column) -> Column:
    """1 is true, 0 is false, all else is NULL."""
    text = flag.cast("string")
    return F.when(text == "1", F.lit(True)).when(text == "0", F.lit(False))


def without_markup(text: Column) -> Column:
    """Text without square brackets and double quotes."""
    return F.translate(text, '[]"', "")


def labelled(value: Column, mapping: dict, default=None) -> Column:
    """The label of a value; a value without one gets ``default``."""
    if not mapping:
        return F.lit(default)
    first, *rest = mapping.items()
    chain = F.when(value == F.lit(first[0]), F.lit(first[1]))
    for key, label in rest:
        chain = chain.when(value == F.lit(key), F.lit(label))
    return chain if default is None else chain.otherwise(F.lit(default))


def left_closed_bucket(value: Column, edges: list, labels: list[str]) -> Column:
    """Bucket ``i`` holds ``edges[i-1] <= value < edges[i]``; both ends are open, NULL stays NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        chain = chain.when(value < edge, label)
    return chain.otherwise(labels[-1])


def right_closed_bucket(value: Column, edges: list, labels: list[str]) -> Column:
    """Bucket ``i`` holds ``edges[i] < value <= edges[i+1]``; values outside all buckets give NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label less than edges is needed")
    chain = F.when(value <= edges[0], F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        chain = chain.when(value <= edge, label)
    return chain


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def log_measure(value: Column) -> Column:
    """Decimal logarithm; NULL at zero and below."""
    return F.log10(value)


def weighted_score(rating: Column, votes: Column) -> Column:
    return rating * F.log10(votes + 1)


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent; NULL when there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def unit_ratio(value: Column, per: float) -> Column:
    """A value in a bigger unit, as minutes in hours."""
    return value / F.lit(float(per))


def spread_label(spread: Column, cuts: tuple[float, float], labels: tuple[str, str, str]) -> Column:
    """Three labels by two cuts on a standard deviation; a NULL spread has no label."""
    return left_closed_bucket(spread, list(cuts), list(labels))


def text_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def text_prefix(text: Column, length: int) -> Column:
    """The first characters of a text, for display."""
    return F.substring(text, 1, length)


def text_or(value: Column, default: str) -> Column:
    """A text to show for a missing value."""
    return F.coalesce(value.cast("string"), F.lit(default))


def split_to_array(text: Column, sep: str = ",") -> Column:
    """A list in text form to an array; a missing list gives an empty array."""
    return F.coalesce(F.split(text, _literal(sep)), F.array().cast("array<string>"))


def array_is_empty(values: Column) -> Column:
    return F.size(values) == 0


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _literal(sep: str) -> str:
    """A separator as a pattern that matches only itself. A single character, escaped where it has a
    meaning, is split without compiling a pattern for each row."""
    if len(sep) == 1:
        return "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    return "\\Q" + sep + "\\E"

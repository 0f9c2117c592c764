"""Find secrets in texts with built-in column functions: known forms, and strings of high entropy in a sliding window."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.llm.shared import only

# The known forms, in the order of their kinds.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the maximal runs of 16 or more
ASSIGN_LEAST, ACCESS_LEAST = 12, 18


@dataclass(frozen=True)
class CharClass:
    """Candidate strings of one character class, and when a window over one of them looks random."""

    kind: str
    pattern: str
    window: int
    bits: float  # entropy that some window has to reach
    needs: tuple[str, ...]  # patterns that each have to occur in the candidate


CLASSES = (
    CharClass("lower36", r"[0-9a-z]{20,}", 20, 3.4, (r"[a-z].*[a-z].*[a-z]", r"[0-9].*[0-9].*[0-9]")),
    CharClass("upper36", r"[0-9A-Z]{20,}", 20, 3.4, (r"[A-Z].*[A-Z].*[A-Z]", r"[0-9].*[0-9].*[0-9]")),
    CharClass("base64", r"[A-Za-z0-9+/_-]{24,}", 24, 3.9, (r"[a-z]", r"[A-Z]", r"[0-9]")),
)
# Candidates that match one of these are not reported: examples, placeholders, counting sequences, named checksums, UUIDs.
ALLOWED = (r"(?i)example|sample|placeholder|changeme|dummy|lorem|0123456789|123456789a|abcdefghij",
           r"(.)\1{7}", r"(?i)^(sha-?\d+|md5|crc\d*)[-_=]", r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
# Nor candidates right after the name of a checksum.
ALLOWED_BEFORE = r"(?i)(sha-?\d+|md5|crc\d*|integrity|checksum|etag|uuid|commit)[\"']?[-:= ]*[\"']?$"


BLOCK = 256  # matches whose lengths are added up at a time


def _found(text: Column, pattern: str) -> Column:
    """All matches with their places: structs of start, end (code points, end exclusive), match, and the text before it.

    The pieces between matches and the matches themselves, laid end to end, give the places. Lengths are summed by blocks, and
    a place is its block's sum and the few lengths ahead of it there, so that no long array is built step by step.
    """
    def places(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda p: F.char_length(p["gap"]) + F.char_length(p["found"]))
        return F.element_at(F.transform(F.array(F.struct(pairs.alias("pairs"), sizes.alias("sizes"))), _sums), 1)

    def _sums(x: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(x["sizes"]) - 1) / BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: _total(F.slice(x["sizes"], b * BLOCK + 1, F.lit(BLOCK))))
        ahead = F.aggregate(sums, F.expr("array(0)"), lambda out, n: F.array_append(out, F.element_at(out, -1) + n))
        return F.element_at(F.transform(F.array(F.struct(x["pairs"].alias("pairs"), x["sizes"].alias("sizes"), ahead.alias("ahead"))), _rows), 1)

    def _rows(x: Column) -> Column:
        def row(p: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            before = F.element_at(x["ahead"], block + 1) + _total(F.slice(x["sizes"], block * BLOCK + 1, i - block * BLOCK))
            start = before + F.char_length(p["gap"])
            return F.struct(start.alias("start"), (start + F.char_length(p["found"])).alias("end"), p["found"].alias("found"),
                            F.right(p["gap"], F.lit(24)).alias("before"))

        return F.transform(x["pairs"], row)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(matches, F.split(text, pattern, -1), lambda m, g: F.struct(m.alias("found"), g.alias("gap")))
    pairs = F.filter(pairs, lambda p: p["found"].isNotNull())  # what follows the last match has none
    # Most texts have no match: one cheap search spares them the rest.
    none = F.expr("cast(array() as array<struct<start: int, end: int, found: string, before: string>>)")
    return F.when(text.rlike(pattern), places(pairs)).otherwise(none)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, n: a + n)


# Counts of a window are five bits wide, twelve to a whole number; characters run from "+" to "z".
_FIRST, _LAST, _BITS, _PER = ord("+"), ord("z"), 5, 12
_FIELDS = -(-(_LAST - _FIRST + 1) // _PER)


def window_entropy(text: Column, size: int) -> Column:
    """The highest Shannon entropy, in bits a character, of any ``size`` (at most 31) consecutive characters between ``+`` and
    ``z``; 0 for shorter texts.

    Entropy is log2(size) - sum(c log2 c) / size over the character counts c. The counts are kept while the window moves: a
    step takes the leaving character out of them and puts the entering one in, and each changes the sum by one term.
    """
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(size + 2)])

    def term(count: Column) -> Column:
        return F.element_at(terms, count.cast("int") + 1)

    def step(state: Column, event: Column) -> Column:
        field, shift = F.floor(event["code"] / _PER).cast("int"), ((event["code"] % _PER) * _BITS).cast("int")
        own = F.element_at(F.array(*[state[f"f{k}"] for k in range(_FIELDS)]), field + 1)
        count = F.call_function("shiftright", own, shift).bitwiseAND(F.lit((1 << _BITS) - 1))
        change = F.call_function("shiftleft", event["by"], shift)
        total = state["total"] + term(count + event["by"]) - term(count)
        bits = F.when(event["full"], F.lit(math.log2(size)) - total / size).otherwise(0.0)
        changed = F.struct(*[F.when(field == k, state[f"f{k}"] + change).otherwise(state[f"f{k}"]).alias(f"f{k}") for k in range(_FIELDS)],
                           total.alias("total"), F.greatest(state["best"], bits).alias("best"))
        return F.when(event["code"].isNull(), state).otherwise(changed)

    def moves(codes: Column) -> Column:
        """The characters that leave and enter, in turn; none leaves before the window is full."""
        leaving = F.concat(F.array_repeat(F.lit(None).cast("int"), size), codes)
        return F.flatten(F.zip_with(F.transform(codes, lambda c, i: F.struct(c.alias("code"), (i >= size - 1).alias("full"))), leaving, lambda c, out: F.array(
            F.struct(out.alias("code"), F.lit(-1).cast("long").alias("by"), F.lit(False).alias("full")),
            F.struct(c["code"].alias("code"), F.lit(1).cast("long").alias("by"), c["full"].alias("full")))))

    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) - _FIRST)
    start = F.struct(*[F.lit(0).cast("long").alias(f"f{k}") for k in range(_FIELDS)], F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
    best = F.element_at(F.transform(F.array(codes), lambda c: F.aggregate(moves(c), start, step)["best"]), 1)
    return F.when(F.char_length(text) >= size, best).otherwise(0.0)


def _random_looking(kind: CharClass, known: Column) -> Column:
    """Candidates of a class that overlap no known form, that nothing allows, and that have a window of high entropy."""
    def keep(x: Column) -> Column:
        text = x["found"]
        shape = F.lit(True)
        for need in kind.needs:
            shape = shape & text.rlike(need)
        for allowed in ALLOWED:
            shape = shape & ~text.rlike(allowed)
        shape = shape & ~x["before"].rlike(ALLOWED_BEFORE)
        return F.when(shape, window_entropy(text, kind.window) >= kind.bits).otherwise(False)

    found = _found(F.col("text"), kind.pattern)
    return F.filter(F.when(F.size(known) > 0, _free(found, known)).otherwise(found), keep)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Documents (``doc_id``, ``text``) with ``base``, the spans of known forms, and ``spans``, these and the others:
    arrays of structs (``start``, ``rank`` of the kind, ``kind``, ``end``) ordered by start, then kind.

    Known forms are assignments of 12 or more characters to a password, secret, token or key, access keys of 18 or more,
    and hexadecimal runs of 16 or more. Others are candidates of one character class with a window of high entropy that
    the allow-list doesn't name and that overlap no known form; of two candidates that overlap, the kind listed first
    stays. Missing and empty texts have no spans; rows stay as they are, with repeated ids too; other columns are ignored.
    """
    rows = only(docs, {"doc_id": "long", "text": "string"})
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    assign = F.filter(_found(F.col("text"), ASSIGN),
                      lambda x: F.char_length(F.regexp_extract(x["found"], ASSIGN, 2)) >= ASSIGN_LEAST)
    access = F.filter(_found(F.col("text"), ACCESS), lambda x: F.char_length(x["found"]) >= ACCESS_LEAST)
    forms = [("assign", assign), ("access", access), ("hex", _found(F.col("text"), HEX))]
    rows = rows.select("doc_id", "text", F.concat(*[_spans(col, rank, kind) for rank, (kind, col) in enumerate(forms)]).alias("known"))
    rows = rows.select("doc_id", "known", *[
        _spans(_random_looking(kind, F.col("known")), rank, kind.kind).alias(kind.kind) for rank, kind in enumerate(CLASSES, len(forms))])
    spans = F.col("known")
    for kind in CLASSES:
        spans = F.concat(spans, F.when(F.size(kind.kind) > 0, _free(F.col(kind.kind), spans)).otherwise(F.col(kind.kind)))
    return rows.select("doc_id", F.array_sort("known").alias("base"), F.array_sort(spans).alias("spans"))


def _free(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of the taken ones.

    Taken spans that begin before a span's end, less those that end at or before its start, are the ones that overlap it; both
    numbers come from bisection in sorted arrays.
    """
    def search(x: Column) -> Column:
        return F.filter(spans, lambda s: _below(x["starts"], s["end"], F.lit(False)) == _below(x["ends"], s["start"], F.lit(True)))

    sorted_ends = F.struct(F.array_sort(F.transform(taken, lambda t: t["start"])).alias("starts"),
                           F.array_sort(F.transform(taken, lambda t: t["end"])).alias("ends"))
    return F.element_at(F.transform(F.array(sorted_ends), search), 1)


def _below(numbers: Column, bound: Column, equal: Column) -> Column:
    """How many of the sorted numbers lie below the bound, or at it too."""
    def step(low: Column, i: Column) -> Column:
        middle = low + F.call_function("shiftleft", F.lit(1), 30 - i)
        value = F.try_element_at(numbers, middle)
        return F.when((middle <= F.size(numbers)) & ((value < bound) | (equal & (value == bound))), middle).otherwise(low)

    # Steps by falling powers of two; the first ones are longer than any text has matches.
    return F.aggregate(F.sequence(F.lit(6), F.lit(30)), F.lit(0), step)


def _spans(found: Column, rank: int, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

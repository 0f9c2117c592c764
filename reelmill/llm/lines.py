"""Delete later copies of repeated runs of lines: winnowing over line hashes, with built-in column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.llm.shared import frozen, only

RUN_LINES = 3  # a repeated run has so many lines,
RUN_WORDS = 20  # or so many words in fewer lines, or is a whole text
ROW = ("doc_id", "text_id", "copy")
_WORDS = r"[^\x20\x09-\x0D]+"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used for the elements of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _run(x: Column, first: Column, size: Column, whole: bool) -> Column:
    """A run of lines: its place, the fingerprint that winnowing selects in it (its smallest line hash), that line (the last
    such one), and two hashes of the whole run."""
    hashes = F.slice(x["hashes"], first + 1, size)
    low = F.array_min(hashes)
    return F.struct(first.alias("first"), size.alias("size"), low.alias("fingerprint"),
                    (first + size - F.array_position(F.reverse(hashes), low)).cast("int").alias("at"),
                    F.xxhash64(F.lit(whole), hashes).alias("run"), F.hash(F.slice(x["checks"], first + 1, size)).alias("check"))


def _runs(x: Column, size: int) -> Column:
    """For each line the run of ``size`` lines that begins there, if it is long enough to count, else null."""
    def one(i: Column) -> Column:
        words = F.aggregate(F.slice(x["words"], i + 1, F.lit(size)), F.lit(0), lambda n, w: n + w)
        enough = (i + size <= F.size(x["hashes"])) & (words >= (1 if size >= RUN_LINES else RUN_WORDS))
        return F.when(enough, _run(x, i, F.lit(size), False))

    return F.transform(F.sequence(F.lit(0), F.size(x["hashes"]) - 1), one)


def _selected(lines: Column) -> Column:
    """The lines of a text that some run selects as its fingerprint, each with the runs that do: structs of ``fingerprint``
    and ``runs``. Runs that hold a line begin at most two lines ahead of it, so only those are looked at."""
    hashed = F.struct(F.transform(lines, lambda x: F.xxhash64(x)).alias("hashes"), F.transform(lines, lambda x: F.hash(x)).alias("checks"),
                      F.transform(lines, lambda x: F.regexp_count(x, F.lit(_WORDS))).alias("words"))

    def by_size(x: Column) -> Column:
        n = F.size(x["hashes"])
        whole = F.when((n < RUN_LINES) & F.exists(x["words"], lambda w: w > 0), _run(x, F.lit(0), n, True))
        return _bound(F.struct(x["hashes"].alias("hashes"), whole.alias("whole"),
                               *[_runs(x, k).alias(f"of{k}") for k in range(1, RUN_LINES + 1)]), by_line)

    def by_line(x: Column) -> Column:
        def one(hash_: Column, i: Column) -> Column:
            around = F.concat(F.array(x["whole"]), *[
                F.slice(x[f"of{k}"], F.greatest(i - k + 2, F.lit(1)), F.least(F.lit(k), i + 1)) for k in range(1, RUN_LINES + 1)])
            return F.struct(hash_.alias("fingerprint"), F.filter(around, lambda w: w["at"] == i).alias("runs"))

        return F.filter(F.transform(x["hashes"], one), lambda s: F.size(s["runs"]) > 0)

    return _bound(hashed, by_size)


def _rows(docs: DataFrame) -> DataFrame:
    """Each row with ``text_id`` and ``copy``, which tell rows that share a doc_id apart: a hash of the text, and a number
    from 0 for rows that are equal in both."""
    rows = only(docs, {"doc_id": "long", "text": "string"}).withColumn("text_id", F.xxhash64("text"))
    again = rows.groupBy(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text")).agg(F.count("*").alias("times"))
    again = frozen(again.where("times > 1").select("of", "of_text"), "equal-rows")
    if again.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text"))
    # Equal rows are counted and dealt out again, so that none of them depends on the order of rows.
    several = rows.join(again, same, "left_semi").groupBy("doc_id", "text", "text_id").agg(F.count("*").alias("times"))
    several = several.select("doc_id", "text", "text_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("copy"))
    return rows.join(again, same, "left_anti").withColumn("copy", F.lit(0).cast("long")).union(several)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Later copies of runs of lines in ``_rows``: ``doc_id``, ``text_id``, ``copy`` and ``line``, the places (from 0) of all lines
    in them.

    Only fingerprints are shuffled, one row for each line that a run selects; equal runs select equal lines. Positions whose
    fingerprint occurs nowhere else are dropped. The others are extended both ways: to each run of lines around
    the position that selected it. Of equal runs, the first by (doc_id, text_id, copy, line) stays. Longer matches are
    the union of these runs, step by step, so that no pair of positions has to be made: a line in a third of all documents
    is no large group, as counts and first places combine before they are shuffled, and the joins back to them can be
    split by adaptive execution.
    """
    rows = docs.where(F.col("text").isNotNull()).select(*ROW, F.explode(_selected(F.split("text", "\n", -1))).alias("s"))
    found = frozen(rows.select(*ROW, "s.fingerprint", F.transform("s.runs", lambda w: F.struct(
        w["first"].alias("first"), w["size"].alias("size"), w["run"].alias("run"), w["check"].alias("check"))).alias("runs")), "line-fingerprints")
    position = F.struct(*ROW, F.element_at("runs", 1)["first"].alias("first"))
    again = found.groupBy("fingerprint").agg(F.min(position).alias("a"), F.max(position).alias("b")).where(
        "a is distinct from b").select("fingerprint")
    candidates = frozen(found.join(again, "fingerprint", "left_semi").select(*ROW, F.inline("runs")), "line-candidates")
    key = ["size", "run", "check"]
    first = candidates.groupBy(*key).agg(F.min(F.struct(*ROW, "first")).alias("kept"))
    later = candidates.join(first, key).where("struct(doc_id, text_id, copy, first) is distinct from kept")
    return later.select(*ROW, F.explode(F.sequence("first", F.col("first") + F.col("size") - 1)).alias("line"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Documents (``doc_id``, ``text``) with ``n_lines``, ``n_removed`` and ``kept``, the text without repeated runs.

    Lines are the pieces between line feeds; equal means equal bytes. A run is three lines that are not all blank, or one or
    two lines of 20 words or more. A line goes if it lies in a run that also occurs at an earlier (doc_id, line), or in a text of one
    or two lines, not blank, that is the whole text of an earlier document too. Runs are judged on the input, not on what
    is left. A missing text has no lines and stays missing, an empty one has one empty line. Rows that
    repeat a doc_id are documents of their own, in the order of a 64-bit hash of their texts; of equal rows one is the
    first. A missing doc_id is an id like any other and comes first. Other columns are ignored.
    """
    rows = _rows(docs)
    gone = repeated_runs(rows).groupBy(
        F.col("doc_id").alias("of"), F.col("text_id").alias("of_text"), F.col("copy").alias("of_copy")).agg(
        F.collect_set("line").alias("gone"))
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text"))
                     & (F.col("copy") == F.col("of_copy")), "left").select(
        "doc_id", "text", F.coalesce(F.split("text", "\n", -1), F.expr("cast(array() as array<string>)")).alias("lines"),
        F.map_from_arrays("gone", F.transform("gone", lambda _: F.lit(True))).alias("gone"))
    kept = F.filter("lines", lambda x, i: ~F.map_contains_key(F.col("gone"), i))
    kept = F.when(F.col("gone").isNotNull(), kept).otherwise(F.col("lines"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size(kept)).cast("long").alias("n_removed"),
                       F.when(F.col("text").isNotNull(), F.array_join(kept, "\n")).alias("kept"))

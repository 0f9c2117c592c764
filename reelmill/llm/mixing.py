"""Mix documents of several sources to target weights, by nested thresholds on a hash of the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.shared import frozen, key_hash, only

HASH_BITS = 60
LEVEL_BITS = 10  # a histogram has 1,024 buckets a source
WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in code-point order, repeating
MOST_REPEATS = 3
SPREAD = 64  # tasks that share one source's documents


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source (``source``, ``source_size``) with its share of all sizes by weight, none above ``most`` times
    its own size.

    What exceeds a cap is shared again by weight. The fixed point is a water level: with sources ordered by cap over
    weight, the first source that its share does not fill, and all after it, get level times weight. The table has a row
    per source, so ordering it is small work.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                           / F.sum("weight").over(after))
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(open_level, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def _hash() -> Column:
    """A hash of a document's id and text."""
    return key_hash(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Documents (``doc_id``, ``text``, ``source``) with ``size`` in words, ``source_size``, ``target`` and ``taken``.

    A source takes every document as often as its target holds its whole size, and once more those whose hash lies below
    a threshold. The threshold is found without sorting: sizes are summed by source and the next ten bits of the hash,
    and only the bucket in which the budget ends is split further, until it is a single hash. The document there is taken
    if that comes nearer to the budget (a half or more of it fits). A source's taken words so miss its target by half a
    document at most. The hash is one of id and text, so rows without an id, or that repeat one, are decided one by one;
    rows that are equal in both share a decision.

    Missing texts have size 0, missing sources are a source of their own and come last, a missing id or text hashes like an
    empty one; an empty table gives no rows. Other columns are ignored.
    """
    rows = only(docs, {"doc_id": "long", "text": "string", "source": "string"})
    rows = frozen(rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), _hash().alias("hash")), "mix-sizes")
    return _with_cuts(rows, thresholds(rows, weights, most)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The mix itself: each document (``doc_id``, ``text``, ``source`` and other columns) as often as it is taken."""
    # Whole rows travel as one value, so that no column can clash with the operator's own.
    docs = docs.select("source", word_count(F.col("text")).alias("size"), _hash().alias("hash"), F.struct("*").alias("row"))
    cuts = thresholds(frozen(docs.drop("row"), "mix-sizes"), weights, most)
    times = F.when(F.col("size") > 0, F.col("times")).otherwise(0).cast("int")
    return _with_cuts(docs, cuts).select("row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")


def _with_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with their source's cut and ``times``, how often each is taken. A large source is spread over several tasks."""
    spread = cuts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.pmod(F.col("hash"), F.lit(SPREAD)) == F.col("part"))
    times = F.col("repeats") + (F.col("hash") < F.col("threshold")).cast("long")
    return rows.join(spread, same).withColumn("times", times)


def thresholds(rows: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    """For each source (``of``): ``source_size``, ``target``, ``repeats`` of every document, and the ``threshold`` below which
    a document's hash takes it once more. ``rows``: source, size and hash of each document."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(totals, weights, most).withColumn(
        "repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    )
    # left: words the budget still holds at the start of the bucket; low: where that bucket begins
    cuts = plan.select("source", (F.col("target") - F.col("repeats") * F.col("source_size")).alias("left"),
                       F.lit(0).cast("long").alias("low"), "source_size", "target", "repeats")
    cuts = frozen(cuts, "mix-targets")
    for bits in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        cuts = frozen(_refine(rows, cuts, bits), "mix-level")
    at_edge = F.col("source").eqNullSafe(F.col("at")) & (F.col("hash") == F.col("low"))
    edge = rows.join(cuts.select(F.col("source").alias("at"), "low"), at_edge).groupBy("at").agg(F.sum("size").alias("edge_size"))
    return frozen(cuts.join(edge, F.col("source").eqNullSafe(F.col("at")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "repeats",
        # the threshold passes the edge document if at least half of it fits into what is left
        F.when((F.col("edge_size") > 0) & (F.col("left") * 2 >= F.col("edge_size")), F.col("low") + 1)
        .otherwise(F.col("low")).alias("threshold")), "mix-cuts")


def _refine(rows: DataFrame, cuts: DataFrame, bits: int) -> DataFrame:
    """Split each source's open bucket by the next ``LEVEL_BITS`` bits and move to the part in which its budget ends."""
    open_bucket = cuts.select(F.col("source").alias("of"), "low")
    inside = F.shiftright("hash", bits + LEVEL_BITS) == F.shiftright("low", bits + LEVEL_BITS)
    if bits + LEVEL_BITS == HASH_BITS:  # everything lies in the first bucket
        sums = rows.groupBy(F.col("source").alias("of"), F.shiftright("hash", bits).alias("bucket"))
    else:
        sums = rows.join(open_bucket, F.col("source").eqNullSafe(F.col("of")) & inside).groupBy(
            "of", F.shiftright("hash", bits).alias("bucket"))
    sums = sums.agg(F.sum("size").alias("words"))
    order = Window.partitionBy("of").orderBy("bucket")  # a source has at most 2 ** LEVEL_BITS rows here
    sums = sums.withColumn("start", F.sum("words").over(order) - F.col("words")).withColumnRenamed("of", "part")
    found = cuts.join(sums, F.col("source").eqNullSafe(F.col("part")), "left")
    here = (F.col("start") <= F.col("left")) & (F.col("words") > 0)
    chosen = found.groupBy("source", "left", "low", "source_size", "target", "repeats").agg(
        F.max(F.when(here, F.struct("bucket", "start"))).alias("cut"))
    return chosen.select(
        "source", (F.col("left") - F.coalesce(F.col("cut.start"), F.lit(0))).alias("left"),
        F.coalesce(F.shiftleft(F.col("cut.bucket"), bits), F.col("low")).cast("long").alias("low"),
        "source_size", "target", "repeats")

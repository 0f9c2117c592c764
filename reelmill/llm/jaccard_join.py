"""Similarity join of documents by the Jaccard coefficient of their word shingles, with a token-group matrix.

Similar documents form groups. A table of tokens and groups (the matrix) says which groups a document may have a partner
in; the overlap with a group's token union bounds the overlap with each member, and only groups that reach the least
overlap are opened. What is asked for are links up to connectivity, so a document is never compared with members of its
own component, which keeps large groups of copies linear.

1. Every document becomes its set of shingle hashes; equal sets are one class with one representative.
2. Tokens are ordered by how full their bucket in a table of 2**22 counters over the whole corpus is, then by hash. Two
   sets of n and m tokens that reach the threshold share a token among the first n - ceil(t n) + 1 of either, whatever the
   order is; the counters only put tokens of common passages last.
3. Each prefix token has a centre, the set whose tokens are shared most. Each set is compared with the centre it shares most prefix
   tokens with, if the tokens behind the last shared one still suffice; linked sets are the first groups.
4. The matrix of prefix tokens and groups, cut into blocks of members, gives the blocks of *other* groups that a set has
   to be bounded against and, if it qualifies, compared with until one member links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.components import connected_components
from reelmill.llm.shared import frozen, give_back, only, small_batches
from reelmill.llm.words import hashes, mix, raw, shingles, slices

SHINGLE = 5
PERCENT = 80
COUNTER_BITS = 22  # 4 MB of counters are broadcast, whatever the size of the corpus
COUNTER_BLOCK = 1 << 16  # counters in a row on their way there
BLOCK = 256  # members that a task holds while queries pass
FILTER_BITS = 26  # an 8 MB bit map of the documents whose sets are read again


def least_overlap(size: int, percent: int) -> int:
    """The least intersection of a set of this size with any set that reaches the threshold."""
    return -(-percent * size // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted distinct arrays reach ``100 * intersection >= percent * union``."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    both = _common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many of a's values the sorted array b has."""
    if not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    data, offsets = raw(texts)
    for start, stop in slices(texts):
        words, bounds = hashes(data, offsets[start:stop + 1], fold=True)
        yield from shingles(words, bounds, size)


def token_counters(texts: DataFrame, size: int) -> np.ndarray:
    """About how many distinct shingles of all documents fall into each of ``2**COUNTER_BITS`` buckets, on a scale of
    logarithms. A task's own count stops at 255, which only very common tokens reach."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int32)
        for batch in batches:
            for one in _sets(batch.column("text"), size):
                np.add.at(total, one >> np.uint64(64 - COUNTER_BITS), 1)
        if total.any():
            blocks = np.minimum(total, 255).astype(np.uint8).reshape(-1, COUNTER_BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(
                [x.tobytes() for x in blocks], pa.binary())], names=["block", "counts"])
        del total
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
                have = sums.setdefault(block, np.zeros(COUNTER_BLOCK, np.int64))
                have += np.frombuffer(counts.as_buffer(), np.uint8)
        scaled = [np.minimum(8 * np.log2(1 + x), 255).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(scaled, pa.binary())], names=["block", "counts"])

    ddl = "block int, counts binary"
    rows = frozen(texts.mapInArrow(count, ddl).repartition("block").mapInArrow(add, ddl), "token-counters")
    out = np.zeros((1 << COUNTER_BITS) // COUNTER_BLOCK * COUNTER_BLOCK, np.uint8).reshape(-1, COUNTER_BLOCK)
    for row in rows.collect():
        out[row.block] = np.frombuffer(row.counts, np.uint8)
    return out.ravel()


def _heads(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document: ``n`` shingles, ``set_id`` (a hash of the whole set) and ``prefix``, its first tokens in the order."""
    counters = docs.sparkSession.sparkContext.broadcast(token_counters(docs.select("text"), size))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = counters.value
        for batch in batches:
            sets = _sets(batch.column("text"), size)
            for start, stop in slices(batch.column("text")):
                counts, ids, prefixes = [], [], []
                for _ in range(stop - start):
                    one = next(sets)
                    counts.append(len(one))
                    ids.append(mix(np.add.reduce(mix(one), keepdims=True) + np.uint64(len(one))))
                    keep = len(one) - least_overlap(len(one), percent) + 1 if len(one) else 0
                    order = np.argsort(full[one >> np.uint64(64 - COUNTER_BITS)], kind="stable")[:keep]
                    prefixes.append(one[order])
                lengths = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, stop - start), pa.array(counts, pa.int32()),
                    pa.array(np.concatenate(ids).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(prefixes).view(np.int64)))],
                    names=["doc_id", "n", "set_id", "prefix"])
        give_back()

    return docs.mapInArrow(make, "doc_id long, n int, set_id long, prefix array<long>")


def _bit_map(ids: DataFrame) -> np.ndarray:
    """A bit map of hashed ids, combined on the cluster; its size doesn't depend on their number."""
    place = F.shiftrightunsigned(F.xxhash64("node"), 64 - FILTER_BITS)
    words = ids.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node`` and ``tokens`` of the wanted documents, and of a few others whose hash collides, from their texts."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bit_map(nodes))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS).alias("place")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            hit = (wanted.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            batch = batch.filter(pa.array(hit.astype(bool)))
            sets = _sets(batch.column("text"), size)
            for start, stop in slices(batch.column("text")):
                tokens = [np.sort(next(sets).view(np.int64)) for _ in range(stop - start)]
                lengths = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, stop - start),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(tokens)))],
                    names=["node", "tokens"])
        give_back()

    rows = docs.where("doc_id is not null").select("doc_id", "text", place)
    return frozen(rows.mapInArrow(make, "node long, tokens array<long>"), "shingle-sets")


def _opened(rows: DataFrame, percent: int) -> DataFrame:
    """Links between queries and members of a block. Rows: ``block``, ``salt``, ``role`` (0 member, 1 query), ``node``,
    ``tokens``; a block's members come first and stay in memory while its queries pass."""
    def open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        members: list[tuple[int, np.ndarray]] = []
        union = np.zeros(0, np.int64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            tokens = batch.column("tokens")
            values, ends = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            names = [batch.column(x).to_pylist() for x in ("block", "salt", "role", "node")]
            for k, (block, salt, role, node) in enumerate(zip(*names, strict=True)):
                own = values[ends[k]:ends[k + 1]]
                if key != (block, salt):
                    key, members, union = (block, salt), [], None
                if role == 0:
                    members.append((node, own.copy()))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([x for _, x in members])) if members else np.zeros(0, np.int64)
                if _common(own, union) < least_overlap(len(own), percent):
                    continue  # no member can reach the threshold
                for member, theirs in members:
                    if linked(own, theirs, percent):
                        found.append((node, member))
                        break  # members are connected: one link is enough
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    dealt = rows.repartition("block", "salt").sortWithinPartitions("block", "salt", "role")
    return dealt.select("block", "salt", "role", "node", "tokens").mapInArrow(open_groups, "a long, b long")


def similar_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Documents (``doc_id``, ``text``) with ``n_shingles``, ``class_id`` and ``component_id``.

    A-Z count as a-z, words are runs without ASCII white space, a document with fewer than ``size`` words is one shingle.
    Two documents link if ``100 * intersection >= percent * union``. class_id is the smallest doc_id with the same set,
    component_id the smallest reachable by links. Missing, empty and blank texts have no shingles and no partner: both ids
    are their own. A document without an id links with nothing and has no class or component. Rows with one doc_id count
    as one document: each row is answered by its own text, and links of either text are links of both. An empty table
    gives no rows; other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    docs = only(small_batches(docs), {"doc_id": "long", "text": "string"})
    heads = frozen(_heads(docs, size, percent), "shingle-heads")
    classes = frozen(heads.where("n > 0 and doc_id is not null").groupBy("set_id", "n").agg(
        F.min("doc_id").alias("class_id")), "shingle-classes")
    components = _components(docs, heads, classes, size, percent)
    out = heads.select("doc_id", "n", "set_id").join(classes, ["set_id", "n"], "left")
    out = out.join(components, F.col("class_id") == F.col("node"), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("class_id"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", own)).alias("component_id"))


def _components(docs: DataFrame, heads: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    # Postings of one representative per class.
    chosen = heads.join(classes.select("set_id", F.col("class_id").alias("doc_id")), ["set_id", "doc_id"], "left_semi")
    postings = chosen.select(F.col("doc_id").alias("node"), "n", F.posexplode("prefix").alias("pos", "token"))
    times = frozen(postings.groupBy("token").agg(F.count("*").alias("times")).where("times > 1"), "shingle-tokens")
    shared = frozen(postings.join(times, "token"), "shingle-shared")

    # A token's centre is the set whose prefix tokens occur most often elsewhere: the original among edited copies.
    degrees = shared.groupBy("node").agg(F.sum("times").alias("degree"))
    centres = shared.join(degrees, "node").groupBy("token").agg(
        F.max(F.struct("degree", "node", "n", "pos")).alias("top")).select(
        "token", F.col("top.node").alias("centre"), F.col("top.n").alias("centre_n"), F.col("top.pos").alias("centre_pos"))
    near = shared.join(frozen(centres, "shingle-centres"), "token").where(
        (F.col("node") != F.col("centre")) & (F.least("n", "centre_n") * 100 >= F.greatest("n", "centre_n") * percent))
    near = near.groupBy("node", "n", "centre", "centre_n").agg(
        F.count("*").alias("common"), F.max("pos").alias("last"), F.max("centre_pos").alias("centre_last"))
    near = near.where(_reachable("n", "last", "centre_n", "centre_last", percent))
    star = near.groupBy("node").agg(F.max(F.struct("common", (-F.col("centre")).alias("minus"))).alias("best"))
    star = frozen(star.select("node", (-F.col("best.minus")).alias("centre")), "shingle-star")
    sets = _sets_of(docs, star.select("node").union(star.select("centre")), size)
    salts = star.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    members = star.join(salts, "centre").withColumn("salt", F.pmod(F.xxhash64("node"), "salts"))
    rows = _with_tokens(members.select(F.col("centre").alias("block"), "salt", F.lit(1).alias("role"), "node"), sets).union(
        _with_tokens(members.select(F.col("centre").alias("block"), "salt", F.lit(0).alias("role"),
                                    F.col("centre").alias("node")).distinct(), sets))
    links = frozen(_opened(rows, percent), "shingle-links")
    groups = frozen(connected_components(links), "shingle-groups")

    # The matrix: prefix tokens that occur in several groups, and the groups' blocks.
    labelled = shared.select("token", "node", "n", "pos").join(groups, "node", "left").withColumn(
        "group", F.coalesce("component", "node")).drop("component")
    mixed = labelled.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high")
    labelled = frozen(labelled.join(mixed.select("token"), "token", "left_semi"), "shingle-mixed")
    sizes = labelled.select("group", "node").distinct().groupBy("group").agg(F.count("*").alias("members"))
    labelled = labelled.join(sizes, "group").withColumn(
        "salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)))
    matrix = labelled.groupBy("token", F.col("group").alias("block"), "salt", F.col("members").alias("block_members")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("block_first"), F.max("pos").alias("block_pos"))
    wanted = labelled.select("token", "node", "n", "pos", "group", "members").join(matrix, "token").where(
        (F.struct("members", "group") < F.struct("block_members", "block"))
        & (F.col("most") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("least") * percent)
        # Only tokens that can be the first common one: enough tokens are left from there on.
        & ((F.col("n") - F.col("pos")) * (100 + percent) >= (F.col("n") + F.col("least")) * percent)
        & ((F.col("most") - F.col("block_first")) * (100 + percent) >= (F.col("n") + F.col("least")) * percent))
    wanted = wanted.groupBy("block", "salt", "node", "n", "block_members").agg(
        F.count("*").alias("common"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.min("least").alias("least"),
        F.max("block_pos").alias("block_last"))
    alone = F.col("block_members") == 1
    # In a block of several members, all tokens from the first shared one on may be common.
    open_end = (F.col("n") - F.col("first")) * (100 + percent) >= (F.col("n") + F.col("least")) * percent
    wanted = wanted.where(F.when(alone, _reachable("n", "last", "least", "block_last", percent)).otherwise(open_end))
    wanted = frozen(wanted.select("block", "salt", "node"), "shingle-queries")
    holders = labelled.select(F.col("group").alias("block"), "salt", "node").distinct().join(
        wanted.select("block", "salt").distinct(), ["block", "salt"], "left_semi")
    sets = _sets_of(docs, wanted.select("node").union(holders.select("node")), size)
    rows = _with_tokens(wanted.select("block", "salt", F.lit(1).alias("role"), "node"), sets).union(
        _with_tokens(holders.select("block", "salt", F.lit(0).alias("role"), "node"), sets))
    more = frozen(_opened(rows, percent), "shingle-more")
    if more.isEmpty():
        return groups
    return frozen(connected_components(links.union(more)), "shingle-components")


def _reachable(n: str, last: str, other_n: str, other_last: str, percent: int):
    """Whether two sets can still link: ``common`` prefix tokens, and behind the last of them at most the rest of either."""
    rest = F.least(F.col(n) - F.col(last), F.col(other_n) - F.col(other_last)) - 1
    return (F.col("common") + rest) * (100 + percent) >= (F.col(n) + F.col(other_n)) * percent


def _with_tokens(rows: DataFrame, sets: DataFrame) -> DataFrame:
    return rows.join(sets, "node").select("block", "salt", "role", "node", "tokens")


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest doc_id, with all its columns.

    Rows that share a doc_id are one document, of which the row with the first text stays; rows without a doc_id have no
    partner and stay.
    """
    found = similar_documents(docs, size, percent).where("doc_id = component_id").select(F.col("doc_id").alias("chosen")).distinct()
    # Whole rows travel as one value, so that no column can clash with the operator's own.
    rows = docs.select("doc_id", F.xxhash64("text").alias("order"), F.struct("*").alias("row"))
    kept = rows.join(found, F.col("doc_id") == F.col("chosen"), "left_semi")
    first = kept.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("order", "row")))
    return first.where("place = 1").select("row.*").union(docs.where("doc_id is null"))

"""Remove passages of many words that occur more than once, with suffix automata of shards of repeated regions.

All windows of 35 words of all documents are judged, but only few have to be looked at word by word:

1. Winnowing: each window selects the smallest hash of its 8-word runs as anchor, at a place that depends on the window
   alone. The consecutive windows of a document that select one anchor are a region, described by a hash of its words.
2. Anchors are counted. One that occurs once has no repeated window; one whose regions are all equal has only repeated
   ones. The rest are undecided, and one copy of each of their distinct regions is read from the texts.
3. These regions are the reference. They are dealt by anchor into shards of bounded size, and a suffix automaton of each
   shard, cut down to what occurs at least twice, gives the matching statistics of the regions streamed through it: a
   window is repeated where the longest repeated suffix has 35 words.
4. An anchor with more distinct regions than a shard should hold is decided by counting its windows instead.

The automata go with the regions that can match them instead of to every task: broadcasting them would cost as many
passes over the corpus as there are shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.shared import frozen, only, small_batches
from reelmill.llm.words import hashes, mix, raw, slices, spans, windows

WINDOW = 35
ANCHOR = 8
SHARD_WORDS = 40_000  # words of distinct regions in one automaton
MOST_REGIONS = 1_000  # distinct regions of one anchor in an automaton; more are decided by window counts
_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)


class SuffixAutomaton:
    """All substrings of several word sequences, with the number of places where each ends."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def add(self, words: list[int], weight: int = 1) -> None:
        """Insert a sequence that occurs ``weight`` times."""
        last = 0
        for word in words:
            last = self._extend(last, word)
            self.count[last] += weight

    def _extend(self, last: int, word: int) -> int:
        step, link, length = self.next, self.link, self.length
        there = step[last].get(word)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._clone(last, word, there)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.count.append(0)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            there = step[at][word]
            link[new] = there if length[there] == length[at] + 1 else self._clone(at, word, there)
        return new

    def _clone(self, at: int, word: int, there: int) -> int:
        step, link = self.next, self.link
        new = len(step)
        step.append(dict(step[there]))
        link.append(link[there])
        self.length.append(self.length[at] + 1)
        self.count.append(0)
        link[there] = new
        while at >= 0 and step[at].get(word) == there:
            step[at][word] = new
            at = link[at]
        return new

    def finish(self) -> None:
        """Pass the counts on to shorter suffixes; nothing can be added afterwards."""
        count, link = self.count, self.link
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if link[state] >= 0:
                count[link[state]] += count[state]

    def statistics(self, words: list[int], least: int = 2) -> list[int]:
        """For each word the length of the longest run that ends there and occurs ``least`` times."""
        step, link, length, count = self.next, self.link, self.length, self.count
        state = size = 0
        out = []
        for word in words:
            there = step[state].get(word)
            while state and (there is None or count[there] < least):
                state = link[state]
                size = length[state]
                there = step[state].get(word)
            if there is not None and count[there] >= least:
                state = there
                size += 1
            out.append(size)
        return out


def _select(words: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of all regions: the row, the first window's first word (in the row), how many windows, the anchor's hash, and the
    hash of the region's words."""
    runs = windows(words, anchor)
    span = window - anchor + 1
    count = len(words) - window + 1
    if count <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    first = np.arange(count)
    row = np.searchsorted(bounds, first, "right") - 1
    whole = first + window <= bounds[row + 1]
    view = np.lib.stride_tricks.sliding_window_view(runs, span)
    chosen = np.empty(count, np.int64)
    for at in range(0, count, 1 << 14):  # small enough for the processor's cache
        part = view[at:at + (1 << 14), ::-1]
        chosen[at:at + len(part)] = np.arange(at, at + len(part)) + span - 1 - part.argmin(axis=1)
    first, row, chosen = first[whole], row[whole], chosen[whole]
    starts = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])])) if len(first) else first
    stops = np.append(starts[1:], len(first)) if len(first) else first
    number = stops - starts
    low = first[starts]
    high = low + number - 1 + window
    power = np.full(len(words) + 1, _STEP, np.uint64)
    back = np.full(len(words) + 1, _BACK, np.uint64)
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:-1])])
    content = mix(mix((sums[high] - sums[low]) * back[low]) + (chosen[starts] - low).astype(np.uint64) * np.uint64(64)
                  + number.astype(np.uint64))
    return row[starts], low - bounds[row[starts]], number, runs[chosen[starts]].view(np.int64), content.view(np.int64)


def _regions(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    ddl = "doc_id long, text_id long, start int, number byte, anchor long, region long"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for start, stop in slices(batch.column("text")):
                words, bounds = hashes(data, offsets[start:stop + 1])
                row, first, number, key, content = _select(words, bounds, window, anchor)
                at = pa.array(start + row)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(at), batch.column("text_id").take(at), pa.array(first, pa.int32()),
                    pa.array(number, pa.int8()), pa.array(key), pa.array(content)],
                    names=["doc_id", "text_id", "start", "number", "anchor", "region"])

    return docs.mapInArrow(make, ddl)


def _read_regions(examples: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """The words, as hashes, of the example regions: ``anchor``, ``region``, ``weight``, ``crowded``, ``words``."""
    lists = examples.groupBy("doc_id", "text_id").agg(
        F.collect_list(F.struct("start", "number", "anchor", "region", "weight", "crowded")).alias("wanted"))
    lists = lists.select(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text"), "wanted")
    texts = docs.join(lists, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text"))).dropDuplicates(
        ["doc_id", "text_id"]).select("text", "wanted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            wanted = batch.column("wanted").to_pylist()
            for start, stop in slices(batch.column("text")):
                words, bounds = hashes(data, offsets[start:stop + 1])
                words = words.view(np.int64)
                out: list[tuple] = []
                for k in range(start, stop):
                    own = words[bounds[k - start]:bounds[k - start + 1]]
                    out += [(x["anchor"], x["region"], x["weight"], x["crowded"],
                             own[x["start"]:x["start"] + x["number"] - 1 + window]) for x in wanted[k]]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)],
                                                 names=["anchor", "region", "weight", "crowded", "words"])

    return texts.mapInArrow(read, "anchor long, region long, weight int, crowded boolean, words array<long>")


def _by_automata(regions: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Which windows of the regions are repeated: ``anchor``, ``region``, ``mask`` (bit i: the window at word i)."""
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size = 0
        last = None
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("anchor", "region", "weight", "words")), strict=True):
                if size >= shard_words and row[0] != last:  # regions of one anchor stay together
                    yield _masks(shard, window)
                    shard, size = [], 0
                shard.append(row)
                size += len(row[3])
                last = row[0]
        if shard:
            yield _masks(shard, window)

    dealt = regions.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "region", "weight", "words").mapInArrow(decide, "anchor long, region long, mask long")


def _masks(shard: list[tuple], window: int) -> pa.RecordBatch:
    automaton = SuffixAutomaton()
    for _, _, weight, words in shard:
        automaton.add(words, weight)
    automaton.finish()
    masks = [sum(1 << i for i, size in enumerate(automaton.statistics(words)[window - 1:]) if size >= window)
             for *_, words in shard]
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in shard], pa.int64()), pa.array([x[1] for x in shard], pa.int64()), pa.array(masks, pa.int64())],
        names=["anchor", "region", "mask"])


def _by_counts(regions: DataFrame, window: int) -> DataFrame:
    """The same for anchors with many distinct regions: count equal windows, combined before they are shuffled."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("anchor", "region", "weight")]
            words = batch.column("words")
            values, ends = words.values.to_numpy().view(np.uint64), words.offsets.to_numpy()
            for k, (key, region, weight) in enumerate(zip(*columns, strict=True)):
                runs = windows(values[ends[k]:ends[k + 1]], window).view(np.int64)
                n = len(runs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.int64()), pa.array([region] * n, pa.int64()), pa.array([weight] * n, pa.int32()),
                     pa.array(range(n), pa.int32()), pa.array(runs)], names=["anchor", "region", "weight", "place", "run"])

    rows = frozen(regions.select("anchor", "region", "weight", "words").mapInArrow(
        each, "anchor long, region long, weight int, place int, run long"), "crowded-windows")
    again = rows.groupBy("run").agg(F.sum("weight").alias("times")).where("times > 1").select("run")
    return rows.join(again, "run", "left_semi").groupBy("anchor", "region").agg(
        F.expr("bit_or(shiftleft(1L, place))").alias("mask"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS,
                     most_regions: int = MOST_REGIONS) -> DataFrame:
    """Regions with repeated windows: ``doc_id``, ``text_id``, ``start`` (first word) and ``mask`` (bit i: the window at word
    start + i occurs elsewhere too). ``docs``: doc_id, text, text_id; a window less the anchor is 62 words at most."""
    found = frozen(_regions(docs, window, anchor), "regions")
    counted = found.groupBy("anchor").agg(
        F.count("*").alias("times"), F.min("region").alias("low"), F.max("region").alias("high")).where("times > 1")
    counted = frozen(counted, "repeated-anchors")  # apart from the join, so that a common anchor's rows can be split there
    again = frozen(found.join(counted.select("anchor", (F.col("low") != F.col("high")).alias("undecided")), "anchor"), "repeated-regions")
    distinct = again.where("undecided").groupBy("anchor", "region").agg(
        F.least(F.count("*"), F.lit(2)).cast("int").alias("weight"),
        F.min(F.struct("doc_id", "text_id", "start", "number")).alias("example"))
    distinct = frozen(distinct, "distinct-regions")
    crowds = distinct.groupBy("anchor").count().where(F.col("count") > most_regions).select("anchor", F.lit(True).alias("many"))
    examples = distinct.join(crowds, "anchor", "left").select(
        "anchor", "region", "weight", "example.*", F.col("many").isNotNull().alias("crowded"))
    words = frozen(_read_regions(examples, docs, window), "reference")
    masks = frozen(_by_automata(words.where("not crowded"), window, shard_words).union(
        _by_counts(words.where("crowded"), window)), "masks")
    decided = again.where("undecided").join(masks, ["anchor", "region"]).where("mask <> 0")
    equal = again.where("not undecided").withColumn("mask", F.expr("shiftleft(1L, cast(number as int)) - 1"))
    return decided.select("doc_id", "text_id", "start", "mask").union(equal.select("doc_id", "text_id", "start", "mask"))


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, **settings: int) -> DataFrame:
    """Documents (``doc_id``, ``text``) with ``n_words``, ``n_removed``, ``kept`` (the words left, joined by single spaces) and
    ``spans``, the maximal removed runs as ``first:end`` in words, joined by commas.

    Words are runs without ASCII white space, compared as they are. A word goes if a window of ``window`` words that covers
    it also starts anywhere else, in this document or another; all occurrences go, and windows are judged on the input.
    Missing and empty texts have no words and keep the empty text; rows that repeat a document are occurrences of their
    own; rows that share an id, also a missing one, are told apart by their texts; an empty table gives no rows; other
    columns are ignored. Words, windows and texts of one id are compared by 64-bit hashes.
    """
    rows = only(small_batches(docs), {"doc_id": "long", "text": "string"}).withColumn("text_id", F.xxhash64("text"))
    # Several rows may share an id and a text: each keeps its own occurrence, all have the same answer.
    gone = repeated_windows(rows, window, **settings).groupBy(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text")).agg(
        F.collect_set(F.struct("start", "mask")).alias("gone"))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for start, stop in slices(batch.column("text")):
                first, end, bounds = spans(data, offsets[start:stop + 1])
                text = data[offsets[start]:offsets[stop]]
                lists = batch.column("gone").slice(start, stop - start).to_pylist()
                counts, removed, kept, runs = [], [], [], []
                for k, marks in enumerate(lists):
                    low, high = bounds[k], bounds[k + 1]
                    flags = np.zeros(high - low + 1, np.int64)
                    for mark in marks or ():
                        for i in range(mark["mask"].bit_length()):
                            if mark["mask"] >> i & 1:
                                flags[mark["start"] + i] += 1
                                flags[mark["start"] + i + window] -= 1
                    out = np.cumsum(flags)[:-1] > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
                    runs.append(",".join(f"{a}:{b}" for a, b in edges.reshape(-1, 2).tolist()))
                    counts.append(high - low)
                    removed.append(int(out.sum()))
                    kept.append(_joined(text, first[low:high][~out], end[low:high][~out]))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, stop - start), pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(runs, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept", "spans"])

    return joined.select("doc_id", "text", "gone").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string, spans string")


def _joined(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """The words between starts and ends, joined by single spaces."""
    if not len(starts):
        return ""
    sizes = ends - starts + 1  # with a space each
    stops = np.cumsum(sizes)
    source = np.arange(stops[-1]) + np.repeat(starts - (stops - sizes), sizes)
    out = text[np.minimum(source, len(text) - 1)]
    out[stops - 1] = 32
    return out[:-1].tobytes().decode()


"""Find benchmark items in documents, exact or with some edits, by a random-walk embedding and bit-sampling LSH.

The embedding reads a text with a pointer: at each step it writes the character it points at and moves on by one or stays,
as a random bit of step and character says. Two texts that differ by few edits fall back into step, so their outputs differ
in few places: edit distance becomes Hamming distance. A sample of the places that a walk writes gives a key. An item is
indexed by the walks from each of its words on, and the item-sized windows of a document begin at each of its words too, so
one undisturbed stretch anywhere in the item is enough. How many steps a key covers, and how many walks are used, is
found for each length class by edits simulated on the items themselves; candidates are verified by their exact edit distance in
characters.

Texts are read in lower case with single spaces, as UTF-8 bytes. In scripts that set no spaces between words, every character
of three or more bytes begins a window.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.shared import empty, give_back, only, small_batches, union
from reelmill.llm.words import mix, raw, slices

SPANS = (44, 36, 30, 26, 22, 18, 15)  # steps that a key may cover; a walk passes a character in two steps on average
SAMPLED = 0.7  # of the steps are read into a key
EDIT_SHARE = 0.15  # of an item's characters that may differ
SHORT_CHARS = 40  # items below this length are looked for as exact copies
TRIAL_SHARE = 0.12  # of the characters edited in trials,
RECALL = 0.96  # and the share of trials to be found, in each length class
TRIALS = 80
WALKS, MOST_WALKS = 2, 6  # walks, if longer spans can do with them, and if even the shortest one can't
PIECE_CHARS = 2_000_000  # benchmark text that is broadcast at a time
DDL = "doc_id long, text_id long, item_id long, edits int, first_word long, n_words int"
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Item:
    item_id: int | None
    text: str  # lower case, single spaces
    limit: int = 0

    @property
    def words(self) -> int:
        return self.text.count(" ") + 1

    @property
    def data(self) -> np.ndarray:
        return np.frombuffer(self.text.encode(), np.uint8)


@dataclass
class Table:
    """Keys of one length class in one walk, sorted, with the item and the place in it that each comes from."""

    span: int
    keys: np.ndarray
    items: np.ndarray
    places: np.ndarray
    some: np.ndarray  # whether any key has these leading bits

    @property
    def shift(self) -> np.uint64:
        return np.uint64(65 - len(self.some).bit_length())


@dataclass
class Index:
    items: list[Item]
    seeds: list[int] = field(default_factory=list)
    tables: list[list[Table]] = field(default_factory=list)  # by walk, by class
    exact: ahocorasick.Automaton | None = None  # short items
    recalls: dict[int, float] = field(default_factory=dict)  # by length class, as found in trials


def normal(text: str) -> str:
    """A lower-case text with its words joined by single spaces."""
    return b" ".join(text.encode().split()).decode()


def make_item(item_id: int | None, text: str) -> Item:
    own = normal(pc.utf8_lower(pa.array([text]))[0].as_py())
    return Item(item_id, own, int(EDIT_SHARE * len(own)))


def normal_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a text column, one after the other, with white space as single blanks, and their offsets. Every row ends in
    a blank."""
    count = len(offsets) - 1
    text = np.full(int(offsets[-1] - offsets[0]) + count, 32, np.uint8)
    at = np.arange(len(text) - count) + np.repeat(np.arange(count), np.diff(offsets))
    text[at] = data[offsets[0]:offsets[-1]]
    space = _SPACE[text]
    text[space] = 32
    keep = np.ones(len(text), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    ends = np.concatenate([[0], offsets[1:] - offsets[0] + np.arange(1, count + 1)])
    keep[ends[1:] - 1] = True  # an empty row keeps its blank
    return text[keep], np.concatenate([[0], np.cumsum(keep)])[ends]


def window_starts(text: np.ndarray) -> np.ndarray:
    """Where windows begin: at words, and at characters of three or more bytes."""
    first = text != 32
    first[1:] &= text[:-1] == 32
    return np.flatnonzero(first | (text >= 0xE0))


def walk(text: np.ndarray, starts: np.ndarray, seed: int, spans: list[int]) -> Iterator[np.ndarray]:
    """The keys of walks from ``starts`` after each of the ascending spans. Behind the text come zeros."""
    rng = np.random.default_rng(seed)
    steps = spans[-1] if spans else 0
    moves = rng.integers(0, 2, (SPANS[0], 256), dtype=np.int64)
    sampled = rng.random(SPANS[0]) < SAMPLED
    padded = np.concatenate([text, np.zeros(steps + 1, np.uint8)])
    at = starts.astype(np.int64)
    key = np.full(len(starts), seed | 1, np.uint64)
    for step in range(steps):
        char = padded.take(at)
        if sampled[step]:
            key *= _MULTIPLIER
            key += char
        at += moves[step].take(char)
        if step + 1 in spans:
            yield mix(key)


def _class(item: Item) -> int:
    """Items of about one length: each class spans half a power of two."""
    return int(2 * math.log2(len(item.text)))


def _edited(text: str, share: float, rng: np.random.Generator) -> str:
    """The text with so many of its characters, at random places, replaced, left out or preceded by another."""
    letters = "abcdefghijklmnopqrstuvwxyz "
    out = list(text)
    for at in sorted(rng.choice(len(out), int(share * len(out)), replace=False).tolist(), reverse=True):
        other = letters[rng.integers(len(letters))]
        kind = rng.integers(3)
        out[at:at + 1] = [other] if kind == 0 else [] if kind == 1 else [other, out[at]]
    return "".join(out)


def trial_rates(items: list[Item], seeds: list[int], share: float = TRIAL_SHARE, trials: int = TRIALS) -> np.ndarray:
    """Whether trials (walk, span, trial) find an edited item of the class: one key of the item and of the edited text agree."""
    rng = np.random.default_rng(len(items))
    spans = sorted(SPANS)
    found = np.zeros((len(seeds), len(spans), trials), bool)
    for trial in range(trials):
        item = items[rng.integers(len(items))]
        other = np.frombuffer(f"so {_edited(item.text, share, rng)} on".encode(), np.uint8)
        for w, seed in enumerate(seeds):
            pairs = zip(walk(item.data, window_starts(item.data), seed, spans), walk(other, window_starts(other), seed, spans), strict=True)
            for s, (mine, theirs) in enumerate(pairs):
                found[w, s, trial] = np.isin(mine, theirs).any()
    return found


def plan(items: list[Item], seeds: list[int], recall: float) -> tuple[int, int, float]:
    """The span and the number of walks for a class of items, and the recall they had in trials: the longest span that reaches
    the target with few walks, else the shortest one with as many as it takes."""
    rates = trial_rates(items, seeds)
    spans = sorted(SPANS)
    least = min(len(item.data) for item in items)
    open_spans = [s for s in range(len(spans)) if spans[s] < least] or [0]  # an exact copy has to hold a whole walk
    for s in reversed(open_spans):
        share = rates[:WALKS, s].any(axis=0).mean()
        if share >= recall:
            return spans[s], WALKS, float(share)
    for walks in range(WALKS + 1, len(seeds) + 1):
        share = rates[:walks, 0].any(axis=0).mean()
        if share >= recall or walks == len(seeds):
            break
    return spans[0], walks, float(share)


def build_index(items: list[Item], recall: float = RECALL, seed: int = 0) -> Index:
    rng = np.random.default_rng(seed)
    seeds = [int(x) for x in rng.integers(1, 1 << 62, MOST_WALKS)]
    classes: dict[int, list[int]] = {}
    short: dict[str, list[int]] = {}
    index = Index(items)
    for k, item in enumerate(items):
        if len(item.text) >= SHORT_CHARS:
            classes.setdefault(_class(item), []).append(k)
        elif item.text:
            short.setdefault(item.text, []).append(k)
    if short:
        index.exact = ahocorasick.Automaton()
        for text, members in short.items():
            index.exact.add_word(text, (members, len(text)))
        index.exact.make_automaton()
    plans = {c: plan([items[k] for k in members], seeds, recall) for c, members in sorted(classes.items())}
    index.recalls = {c: share for c, (_, _, share) in plans.items()}
    index.seeds = seeds[:max((walks for _, walks, _ in plans.values()), default=0)]
    for w, walk_seed in enumerate(index.seeds):
        spans = sorted({span for span, walks, _ in plans.values() if walks > w})
        index.tables.append([_table(items, [k for c, members in classes.items() if plans[c][0] == span and plans[c][1] > w for k in members],
                                    walk_seed, span) for span in spans])
    return index


def _table(items: list[Item], members: list[int], seed: int, span: int) -> Table:
    keys, owner, places = [], [], []
    for k in members:
        starts = window_starts(items[k].data)
        keys.append(next(walk(items[k].data, starts, seed, [span])))
        owner.append(np.full(len(starts), k, np.int32))
        places.append(starts.astype(np.int32))
    keys, owner, places = np.concatenate(keys), np.concatenate(owner), np.concatenate(places)
    order = np.argsort(keys, kind="stable")
    some = np.zeros(1 << min(max(len(keys) * 32, 1 << 16).bit_length(), 26), bool)
    table = Table(span, keys[order], owner[order], places[order], some)
    some[(keys >> table.shift).astype(np.int64)] = True
    return table


def candidates(index: Index, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items and the places in the text where they would begin, from the keys of all windows."""
    starts = window_starts(text)
    items, places = [], []
    for seed, tables in zip(index.seeds, index.tables, strict=True):
        for table, keys in zip(tables, walk(text, starts, seed, [t.span for t in tables]), strict=True):
            hits = np.flatnonzero(table.some[(keys >> table.shift).astype(np.int64)])
            low = np.searchsorted(table.keys, keys[hits], "left")
            many = np.searchsorted(table.keys, keys[hits], "right") - low
            entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
            items.append(table.items[entry])
            places.append(np.repeat(starts[hits], many) - table.places[entry])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *items]).astype(np.int64), np.concatenate([none, *places])


def may_hold(pattern: str, text: str, limit: int) -> bool:
    """Whether enough of the pattern's runs of three characters occur in the text: an edit destroys at most three."""
    runs = {text[i:i + 3] for i in range(len(text) - 2)}
    return sum(pattern[i:i + 3] in runs for i in range(len(pattern) - 2)) >= len(pattern) - 2 - 3 * limit


def edits_within(pattern: str, text: str) -> int:
    """The least edit distance between the pattern and any part of the text, a machine word of bits at a time."""
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = {}
    for i, char in enumerate(pattern):
        where[char] = where.get(char, 0) | 1 << i
    up, down, now = full, 0, size
    best = size
    for char in text:
        same = where.get(char, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        rise = down | (full & ~(across | up))
        fall = up & across
        now += bool(rise & top) - bool(fall & top)
        best = min(best, now)
        rise = rise << 1 & full
        fall = fall << 1 & full
        up = fall | (full & ~(vertical | rise))
        down = rise & vertical
    return best


def _whole_words(text: str, low: int, high: int) -> bool:
    """Whether a match begins and ends at the edge of a word, where its script has such edges."""
    def joined(a: str, b: str) -> bool:
        return all(c.isalnum() and unicodedata.category(c) != "Lo" for c in (a, b))

    return not (low > 0 and joined(text[low - 1], text[low])) and not (high < len(text) and joined(text[high - 1], text[high]))


def _matches(index: Index, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """The best match, fewest edits and first word, for each row and item that reach the limit."""
    text, bounds = normal_bytes(data, offsets)
    best: dict[tuple[int, int], tuple[int, int]] = {}

    def word_at(row: int, place: int) -> int:
        return int(np.count_nonzero(text[bounds[row]:max(place, bounds[row])] == 32))

    if index.exact is not None:
        whole = text.tobytes()
        for row in range(len(bounds) - 1):
            own = whole[bounds[row]:bounds[row + 1]].decode(errors="replace")
            for last, (members, size) in index.exact.iter(own):
                if (row, members[0]) not in best and _whole_words(own, last + 1 - size, last + 1):
                    first_word = own.count(" ", 0, last + 1 - size)
                    best.update({(row, k): (0, first_word) for k in members})
    items, places = candidates(index, text)
    if not len(items):
        return best
    sizes = np.array([len(item.data) for item in index.items])
    limits = np.array([item.limit for item in index.items])
    # A window belongs to the row that most of it lies in; places before the row's start are its own.
    rows = np.clip(np.searchsorted(bounds, places + sizes[items] // 2, "right") - 1, 0, len(bounds) - 2)
    order = np.lexsort((places, items, rows))
    rows, items, places = rows[order], items[order], places[order]
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(rows) != 0) | (np.diff(items) != 0) | (np.diff(places) > 2 * limits[items[1:]] + 2)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    for row, k, low, high in zip(rows[first].tolist(), items[first].tolist(), places[first].tolist(), places[last].tolist(), strict=True):
        item = index.items[k]
        slack = 4 * item.limit + 4  # edits shift places, by up to four bytes a character
        a, b = max(low - slack, int(bounds[row])), min(high + len(item.data) + slack, int(bounds[row + 1]))
        window = text[a:b].tobytes().decode(errors="ignore")
        edits = edits_within(item.text, window) if may_hold(item.text, window, item.limit) else item.limit + 1
        if edits <= item.limit:
            found = (edits, word_at(row, low))
            best[row, k] = min(best.get((row, k), found), found)
    return best


def find_benchmark(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row for each document (``doc_id``, ``text``) and benchmark item (``item_id``, ``text``) that it holds: ``text_id``
    (a 64-bit hash of the text), ``edits``, ``first_word`` (about where, in words) and ``n_words`` of the item.

    An item of 40 characters or more is held if at most 15 % of its characters have to be edited to find it in the document, a
    shorter one if the document has it as it is, as whole words where the script has words. Texts are compared in lower case
    with single spaces. Exact copies are found for certain, items with 12 % of their characters edited in about ``recall`` of
    cases, in every length class (``plan``).

    Missing and empty texts on either side hold and are nothing; rows with the same id and text are one document, rows that
    repeat an item's id are one item, with the best match; a missing id is an id like any other; empty tables give no rows; other
    columns are ignored. The benchmark is broadcast in pieces of bounded size (a longer item is a piece of its own), each with
    a pass over the documents.
    """
    spark = docs.sparkSession
    rows = only(small_batches(docs), {"doc_id": "long", "text": "string"}).withColumn("text_id", F.xxhash64("text"))
    tests = only(benchmark, {"item_id": "long", "text": "string"}).where("text is not null")
    chars = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    pieces = max(1, -(-chars // PIECE_CHARS))
    out = []
    for piece in range(pieces):
        own = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(pieces)) == piece).distinct().collect()
        items = [make_item(row.item_id, row.text) for row in sorted(own, key=lambda r: (r.item_id is None, r.item_id or 0, r.text))]
        items = [item for item in items if item.text]
        if items:
            out.append(_pass(rows, spark.sparkContext.broadcast(build_index(items, recall))))
    if not out:
        return empty(spark, DDL)
    return union(out).groupBy("doc_id", "text_id", "item_id").agg(
        F.min(F.struct("edits", "first_word", "n_words")).alias("best")).select("doc_id", "text_id", "item_id", "best.*")


def _pass(rows: DataFrame, shared) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            texts = pc.utf8_lower(batch.column("text"))
            data, offsets = raw(texts)
            for start, stop in slices(texts):
                best = _matches(index, data, offsets[start:stop + 1])
                if best:
                    found = [(start + row, index.items[k], *match) for (row, k), match in best.items()]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array([x[0] for x in found])),
                        batch.column("text_id").take(pa.array([x[0] for x in found])),
                        pa.array([x[1].item_id for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int32()),
                        pa.array([x[3] for x in found], pa.int64()),
                        pa.array([x[1].words for x in found], pa.int32())],
                        names=["doc_id", "text_id", "item_id", "edits", "first_word", "n_words"])
        del index
        give_back()

    return rows.mapInArrow(search, DDL)


def drop_contaminated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item. Each row is judged by its own text, also if its id is missing or
    repeated."""
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("text_id").alias("bad_text")).distinct()
    own = F.xxhash64(docs["text"].cast("string"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (own == bad["bad_text"]), "left_anti")

"""Runs of words that repeat with a period, found in overlapping tiles of each period octave.

A repetition with period q in [s, 2s) that goes on for 4q words keeps word i equal to word i + q over a stretch of at least
3s places. Every stretch that long holds two neighbouring multiples of s, and at both of them the next s words come again q
words later. So each tile compares, at every multiple of s (a boundary), the s words there with the s words at each of the s
places an octave ahead: the boundary's Z-function, asked whether it reaches s. Hashes of s words are made from those of s/2
words, which makes an octave one pass over the tile. Places that agree are few once periods that are multiples of a smaller
one are left out; these are followed in both directions.

A document of at most ``SINGLE`` words is one tile of every octave and is solved where it is read. Longer ones are exploded
into tiles whose size grows with the octave, the tiles are solved by any task, and the fragments that reach a tile's edge
are stitched by document and period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.shared import frozen, only, small_batches
from reelmill.llm.words import hash_spans, mix, raw, slices, spans

LEAST_WORDS = 6  # length of a run, at least this
LEAST_TIMES = 4  # and so many periods
SINGLE = 1 << 13  # words of a document that is one tile
CORE = 1 << 13  # words that a tile of the first level answers for; twice as many on each further level
FIRST_OCTAVES = 9  # the first level has the periods below 2 ** 9, each further level one octave
_UNIQUE = np.uint64(0xA0761D6478BD642F)


@dataclass
class Fragments:
    """Stretches [``start``, ``stop``) of places in one tile where each word equals the one ``period`` words on."""

    tile: np.ndarray
    period: np.ndarray
    start: np.ndarray
    stop: np.ndarray


@lru_cache(maxsize=4)
def _smallest_factors(size: int) -> np.ndarray:
    """The smallest prime factor of each number below ``size``."""
    found = np.arange(size)
    for p in range(2, isqrt(size) + 1):
        if found[p] == p:
            multiples = found[p * p::p]
            multiples[multiples == np.arange(p * p, size, p)] = p
    return found


def _primitive(short: np.ndarray, long: np.ndarray, s: int, at: np.ndarray, period: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Whether the ``period`` words at each place are no power of fewer words. ``short`` and ``long`` hold hashes of s/2 and s
    words; two of them that overlap cover what has to be compared."""
    keep = np.ones(len(at), bool)
    rest = period.copy()
    while True:
        live = np.flatnonzero(keep & (rest > 1))
        if not len(live):
            return keep
        p = factors[rest[live]]
        step = period[live] // p
        size = period[live] - step
        wide = size >= s
        for hashes, reach, some in ((long, s, wide), (short, max(s // 2, 1), ~wide)):
            k = live[some]
            if len(k):
                a, b, last = at[k], at[k] + step[some], size[some] - reach
                equal = (hashes[a] == hashes[b]) & (hashes[a + last] == hashes[b + last])
                keep[k[equal]] = False
        while True:  # the same factor needs no second look
            again = rest[live] % p == 0
            if not again.any():
                break
            rest[live[again]] //= p[again]


def solve(words: np.ndarray, bounds: np.ndarray, octaves: np.ndarray, cut: np.ndarray) -> Fragments:
    """All long stretches of tiles that lie one after the other.

    ``words`` are hashes, ``bounds`` the offsets of the tiles, ``octaves`` (tile, 2) the first octave of each tile and the one
    behind its last, and ``cut`` tells tiles that are parts of a document. Whole documents give the stretches that make a
    run; parts also give the shorter ones that reach an edge of the tile.
    """
    sizes = np.diff(bounds)
    # A word of its own behind each tile keeps stretches from crossing.
    flat = np.zeros(len(words) + len(sizes), np.uint64)
    starts = bounds[:-1] + np.arange(len(sizes))
    inside = np.ones(len(flat), bool)
    inside[starts + sizes] = False
    flat[inside] = words
    flat[~inside] = mix(np.arange(1, len(sizes) + 1, dtype=np.uint64) * _UNIQUE)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    original = np.arange(len(flat))
    short = long = flat
    out = []
    octave, s = 0, 1
    least = np.where(cut, 2, LEAST_TIMES)  # a part may hold less of a run than all of it
    while True:
        here = (octaves[:, 1] > octave) & (sizes >= least * s)
        if not here.any():
            break
        mask = here[owner]
        if not mask.all():
            owner, original, short, long = owner[mask], original[mask], short[mask], long[mask]
        asked = octaves[:, 0] <= octave
        if asked.any():
            out.append(_octave(flat, starts, sizes, short, long, owner, original, s, cut, asked))
        short = long
        ahead = np.zeros_like(long)
        if len(long) > s:
            ahead[:-s] = long[s:]
        long = mix(long * np.uint64(0xD6E8FEB86659FD93) + ahead)
        octave, s = octave + 1, 2 * s
    if not out:
        return Fragments(*[np.zeros(0, np.int64)] * 4)
    return Fragments(*[np.concatenate([getattr(part, name) for part in out]) for name in ("tile", "period", "start", "stop")])


def _octave(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, short: np.ndarray, long: np.ndarray, owner: np.ndarray,
            original: np.ndarray, s: int, cut: np.ndarray, asked: np.ndarray) -> Fragments:
    count = len(long) // s
    blocks = long[:count * s].reshape(count, s)
    row, shift = np.nonzero(blocks[1:] == blocks[:-1, :1])
    at, period = row * s, shift + s
    # Places near the end of all tiles hash what is not there; tiles that do not ask for this octave are passed through.
    fits = (at + period + s <= len(long)) & (owner[at] == owner[np.minimum(at + period + s - 1, len(long) - 1)])
    fits &= asked[owner[at]]
    at, period = at[fits], period[fits]
    if len(at):
        keep = _primitive(short, long, s, at, period, _smallest_factors(2 * s))
        at, period = at[keep], period[keep]
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != s) | (np.diff(period) != 0) | (owner[at[1:]] != owner[at[:-1]])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(at)))
    tile = owner[at[first]]
    chosen = (many >= 2) | cut[tile]
    found = []
    for k, size, t in zip(first[chosen].tolist(), many[chosen].tolist(), tile[chosen].tolist(), strict=True):
        q = int(period[k])
        base, end = int(starts[t]), int(starts[t] + sizes[t])
        low, high = int(original[at[k]]), int(original[at[k]]) + size * s
        reach = min(s, low - base)  # a boundary further out would have agreed too
        differ = np.flatnonzero(flat[low - reach:low] != flat[low - reach + q:low + q])
        low = low - reach + (int(differ[-1]) + 1 if len(differ) else 0)
        reach = min(s, end - q - high)
        differ = np.flatnonzero(flat[high:high + reach] != flat[high + q:high + q + reach])
        high = high + (int(differ[0]) if len(differ) else max(reach, 0))
        whole = high - low >= max((LEAST_TIMES - 1) * q, LEAST_WORDS - q)
        if whole or (cut[t] and (low == base or high == end - q)):
            found.append((t, q, low - base, high - base))
    return Fragments(*np.array(found, np.int64).reshape(-1, 4).T)


def planted(doc_id: int | None, size: int) -> np.ndarray | None:
    """For ids whose CRC-32 ends in 0, the places of the words that replace a text's words; None for the others."""
    if doc_id is None or size == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % size
    places = np.arange(size)
    places[a:] = a + (places[a:] - a) % (1 + (size - a) // (3 + g % 8))
    return places


def _answer(doc_id: int | None, text: bytes, starts: np.ndarray, ends: np.ndarray, places: np.ndarray | None,
            runs: list[tuple[int, int, int]]) -> tuple:
    """A result row from a document's words and its runs (start, length, period)."""
    runs = sorted(runs, key=lambda r: (r[0], r[2]))
    gone = np.zeros(len(starts) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
    if places is not None:
        kept = places[kept]
    digest = hashlib.sha256()
    for at in range(0, len(kept), 1 << 16):
        some = kept[at:at + (1 << 16)]
        piece = b" ".join([text[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)])
        digest.update(b" " + piece if at else piece)
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    most = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *most, hashlib.sha256(listed.encode()).hexdigest(), digest.hexdigest(), runs


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FIELDS = [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
           ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
           ("runs", pa.list_(_RUN))]
_RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
           "collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _FIELDS]
    columns[-1] = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, _FIELDS, strict=True)],
                                      names=[name for name, _ in _FIELDS])


def _words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Slices of a batch: first row, bytes, word starts and ends, word offsets of the rows, word hashes."""
    data, offsets = raw(batch.column("text"))
    for start, stop in slices(batch.column("text")):
        cuts = offsets[start:stop + 1]
        first, last, bounds = spans(data, cuts)
        text = data[cuts[0]:cuts[-1]]
        yield start, text.tobytes(), first, last, bounds, hash_spans(text, first, last)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that are one tile, from words to results."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for start, text, first, last, bounds, hashes in _words(batch):
            sizes = np.diff(bounds)
            places = [planted(ids[start + k], n) for k, n in enumerate(sizes.tolist())]
            for k, order in enumerate(places):
                if order is not None:
                    hashes[bounds[k]:bounds[k + 1]] = hashes[bounds[k]:bounds[k + 1]][order]
            octaves = np.stack([np.zeros(len(sizes), np.int64), np.full(len(sizes), 64)], axis=1)
            found = solve(hashes, bounds, octaves, np.zeros(len(sizes), bool))
            runs: list[list] = [[] for _ in places]
            for tile, q, low, high in zip(found.tile.tolist(), found.period.tolist(), found.start.tolist(), found.stop.tolist(),
                                          strict=True):
                runs[tile].append((low, high - low + q, q))
            yield _batch([_answer(ids[start + k], text, first[a:b], last[a:b], places[k], runs[k])
                          for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))])


def tiles(size: int, core: int, first_octaves: int) -> Iterator[tuple[int, int, int, int]]:
    """Tiles of a document of ``size`` words: first octave, octave behind the last, first word, word behind the last.

    A tile overlaps its neighbours so far that a stretch which reaches into its core shows it a whole boundary block.
    """
    low, high = 0, first_octaves
    while LEAST_TIMES * 2 ** low <= size:
        if core >= size:  # one tile for all that is left
            yield low, 64, 0, size
            break
        reach = 2 ** (high - 1)  # the longest boundary block of these octaves; periods are shorter than two of them
        for at in range(0, size, core):
            yield low, high, max(at - 2 * reach, 0), min(at + core + 4 * reach, size)
        low, high, core = high, high + 1, 2 * core


def _exploded(core: int, first_octaves: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_id").to_pylist()
            for start, _, _, _, bounds, hashes in _words(batch):
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    order = planted(ids[start + k], b - a)
                    own = hashes[a:b] if order is None else hashes[a:b][order]
                    # Numbers of a document's distinct words take half the room of their hashes.
                    own = np.unique(own, return_inverse=True)[1].astype(np.uint32)
                    for low, high, first, last in tiles(b - a, core, first_octaves):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[start + k]], pa.int64()), pa.array([keys[start + k]], pa.int64()), pa.array([b - a], pa.int64()),
                             pa.array([low], pa.int32()), pa.array([high], pa.int32()), pa.array([first], pa.int64()),
                             pa.array([own[first:last].tobytes()], pa.binary())],
                            names=["doc_id", "text_id", "size", "low", "high", "first", "words"])

    return explode


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_id", "size", "low", "high", "first", "words"]
    for batch in batches:
        for name, key, size, low, high, first, words in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            hashes = mix(np.frombuffer(words, np.uint32).astype(np.uint64) + np.uint64(1))
            whole = len(hashes) == size
            found = solve(hashes, np.array([0, len(hashes)]), np.array([[low, high]]), np.array([not whole]))
            n = len(found.period)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.int64()), pa.array([key] * n, pa.int64()), pa.array(found.period),
                 pa.array(found.start + first), pa.array(found.stop + first)],
                names=["doc_id", "text_id", "period", "low", "high"])


def stitched(fragments: DataFrame) -> DataFrame:
    """Fragments of one document and period that overlap or touch, as whole stretches, and of these the ones that make a run:
    ``doc_id``, ``text_id``, ``start``, ``length``, ``period``."""
    key = ["doc_id", "text_id", "period"]
    order = Window.partitionBy(*key).orderBy("low", "high")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    part = F.sum(F.when(F.col("low") <= F.col("before"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    joined = fragments.withColumn("before", before).withColumn("part", part).groupBy(*key, "part").agg(
        F.min("low").alias("start"), (F.max("high") - F.min("low") + F.col("period")).alias("length"))
    return joined.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_TIMES * F.col("period"))).select(
        "doc_id", "text_id", "start", "length", "period")


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Long documents with their runs, to results."""
    for batch in batches:
        ids, runs = batch.column("doc_id").to_pylist(), batch.column("runs")
        for start, text, first, last, bounds, _ in _words(batch):
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                found = [(r["start"], r["length"], r["period"]) for r in runs[start + k].as_py() or []]
                yield _batch([_answer(ids[start + k], text, first[a:b], last[a:b], planted(ids[start + k], b - a), found)])


def find_runs(docs: DataFrame, single: int = SINGLE, core: int = CORE, first_octaves: int = FIRST_OCTAVES) -> DataFrame:
    """Documents (``doc_id``, ``text``) with their periodic runs, as the ``runs`` (``start``, ``length``, ``period``) and as ``n_runs``,
    the run with the greatest length/period (``start``, ``length``, ``period``, ``exponent_milli``), ``runs_sha256`` and
    ``collapsed_sha256``, a hash of the words that no run contains behind its first period, joined by blanks.

    Words are compared by 64-bit hashes. A run is a maximal stretch of at least six words and four periods; its period is
    the smallest that the stretch has. In documents whose id has a CRC-32 that ends in 0, a rule plants a repetition first
    (``planted``). Ties of the greatest run go to the earliest, then to the smaller period.

    A missing, empty or blank text has no words and no runs; a missing id plants nothing. Each row is answered by itself,
    rows that repeat an id too; an empty table gives no rows; other columns are ignored. A tile of the largest octave holds
    a good part of a very long document, as 64-bit hashes; all else in a task is smaller than the text.
    """
    rows = only(small_batches(docs), {"doc_id": "long", "text": "string"})
    # At least every second byte of n words is a separator, so shorter texts need no count.
    long = (F.octet_length("text") >= 2 * single) & (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) > single)
    long = F.coalesce(long, F.lit(False))
    short = rows.where(~long).mapInArrow(_whole, _RESULT)
    rest = frozen(rows.where(long).withColumn("text_id", F.xxhash64("text")), "long-documents")
    parts = rest.mapInArrow(_exploded(core, first_octaves),
                            "doc_id long, text_id long, size long, low int, high int, first long, words binary")
    parts = parts.repartition("doc_id", "text_id", "low", "first")
    fragments = parts.mapInArrow(_solved, "doc_id long, text_id long, period long, low long, high long")
    found = stitched(fragments).groupBy(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text")).agg(
        F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text"))
    # The texts stay where they are if the runs are few; Spark decides by their size.
    answered = rest.join(found, same, "left").select("doc_id", "text", "runs").mapInArrow(_finished, _RESULT)
    return short.unionByName(answered)

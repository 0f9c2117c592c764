"""How the sources of a language differ in their terms: translate-table tokenizer, counters per document, sparse sums.

One pass of ``bytes.translate`` lowers A-Z and blanks every ASCII character that is no letter, ``bytes.split`` cuts the
terms, and a ``Counter`` for each document gives their frequencies. Tasks add up counters by language and source and hand
on what they hold when it reaches a fixed number of terms, so that only (language, source, term) counts are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.shared import frozen, only, small_batches

LEAST_DOCS = 10  # a language keeps the terms of so many of its documents
SMOOTHING = 2  # added to every count
SCALE = 1000  # probabilities are parts of SCALE ** 3
TOP_TERMS = 10
PIECE = 1 << 20  # bytes of a text that are split at a time
HELD_TERMS = 300_000  # counts that a task holds before it hands them on,
HELD_BYTES = 32 << 20  # and bytes of their terms
OUT_ROWS = 50_000  # rows of a batch that a task hands on
CELLS = 1 << 20  # cells (term, source) that are compared at a time
SPREAD = 64  # tasks that share one language's terms
#: Lower letters, letters outside ASCII as they are, a blank for everything else.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def document_terms(text: bytes) -> Counter:
    """How often each term occurs in a UTF-8 text. Long texts are split in pieces that end at a separator."""
    text = text.translate(TABLE)
    if len(text) <= PIECE:
        return Counter(text.split())
    found, at = Counter(), 0
    while at < len(text):
        stop = text.find(b" ", at + PIECE)
        stop = len(text) if stop < 0 else stop
        found.update(text[at:stop].split())
        at = stop
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
    entries = volume = 0
    for batch in batches:
        columns = [batch.column(name).cast(pa.binary()) for name in ("lang", "source", "text")]
        for k in range(len(batch)):
            lang, source, text = (column[k].as_py() for column in columns)
            count, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(count)
            found = document_terms(text)
            docs.update(found.keys())
            for term, n in found.items():
                count[term] += n
            entries += len(count) - before
            volume += sum(map(len, found)) if len(found) < 1000 else len(text)
            if entries >= HELD_TERMS or volume >= 64 * HELD_BYTES or (volume >= HELD_BYTES and _volume(held) >= HELD_BYTES):
                yield from _handed_on(held)
                held, entries, volume = {}, 0, 0
    yield from _handed_on(held)


def _volume(held: dict) -> int:
    return sum(sum(map(len, count)) for count, _ in held.values())


def _handed_on(held: dict) -> Iterator[pa.RecordBatch]:
    """Rows of what a task holds, and for each (lang, source) a row with the empty term, which no text has."""
    for (lang, source), (count, docs) in held.items():
        count[b""] = 0
        docs[b""] = 0
        terms = list(count)
        for at in range(0, len(terms), OUT_ROWS):
            some = terms[at:at + OUT_ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.binary()), pa.array([source] * len(some), pa.binary()), pa.array(some, pa.binary()),
                 pa.array([count[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Documents (``text``, ``lang``, ``source``) as one row for each ``lang`` and kept ``term`` with ``entries``, the counts
    (``source``, ``n``) of the sources that have it; the empty term lists all sources of the language with 0."""
    rows = only(small_batches(docs), {"lang": "string", "source": "string", "text": "string"})
    rows = rows.select(*[F.coalesce(name, F.lit("")).alias(name) for name in rows.columns])
    found = rows.mapInArrow(_counted, "lang binary, source binary, term binary, n long, docs long")
    found = found.select(*[F.col(name).cast("string").alias(name) for name in ("lang", "source", "term")], "n", "docs")
    # Tasks have added up their documents already; both sums below use this one shuffle.
    found = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("entries"))
    return terms.where((F.col("docs") >= least_docs) | (F.col("term") == "")).select("lang", "term", "entries")


def proportions(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * kept)), exact for totals up to 9 * 10**15.

    The division is carried out in three steps of three digits, so that no product leaves 64 bits.
    """
    whole = np.maximum(total + SMOOTHING * kept, 1)
    rest, out = count + SMOOTHING, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(3):
        step, rest = np.divmod(rest * SCALE, whole)
        out = out * SCALE + step
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q)) of proportions."""
    return (p - q) ** 2 // (p + q)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[dict, np.ndarray]] = {}  # by language: places of its sources, and their totals
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            places = np.array([k for k, name in enumerate(langs) if name == lang])
            if lang not in known:
                all_sources = batch.column("sources")[int(places[0])].as_py()
                known[lang] = {s["source"]: i for i, s in enumerate(all_sources)}, np.array([s["total"] for s in all_sources], np.int64)
            index, totals = known[lang]
            step = max(CELLS // len(totals), 1)
            for at in range(0, len(places), step):
                some = batch.take(pa.array(places[at:at + step]))
                yield from _block(lang, list(index), some, index, totals)


def _block(lang: str, names: list[str], rows: pa.RecordBatch, index: dict, totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums by pair of sources and the best terms of each source, over some terms of one language."""
    terms, kept = rows.column("term").to_pylist(), rows.column("kept")[0].as_py()
    entries = rows.column("entries")
    owner = np.repeat(np.arange(len(terms)), np.diff(entries.offsets.to_numpy()))
    source = entries.flatten().field("source").dictionary_encode()
    place = np.array([index[name] for name in source.dictionary.to_pylist()], np.int64)[source.indices.to_numpy()]
    count = np.zeros((len(terms), len(totals)), np.int64)
    count[owner, place] = entries.flatten().field("n").to_numpy()
    real = np.array([t != "" for t in terms])
    p = proportions(count, totals[None, :], kept)
    p[~real] = 1  # the empty term adds nothing, but each pair gets a row from it
    q = proportions(count.sum(axis=1), totals.sum(), kept)
    q[~real] = 1
    encoded = [t.encode() for t in terms]
    for a, name in enumerate(names):
        sums = distance(p, p[:, a:a + 1]).sum(axis=0)
        others = [i for i in range(len(names)) if i != a]
        gain = distance(p[:, a], q)
        better = np.flatnonzero((count[:, a] > 0) & (p[:, a] > q))
        if len(better) > TOP_TERMS:  # all that tie with the last of the best stay in the choice
            better = better[gain[better] >= -np.partition(-gain[better], TOP_TERMS - 1)[TOP_TERMS - 1]]
        best = sorted(better.tolist(), key=lambda k: (-gain[k], encoded[k]))[:TOP_TERMS]
        size = len(others) + len(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * size, pa.string()), pa.array([name] * size, pa.string()),
             pa.array(["pair"] * len(others) + ["term"] * len(best), pa.string()),
             pa.array([names[i] for i in others] + [terms[k] for k in best], pa.string()),
             pa.array([*sums[others].tolist(), *gain[best].tolist()], pa.int64())],
            names=["lang", "source", "part", "item", "value"])


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """How far the sources of each language lie apart: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Terms are runs of ASCII letters, read as lower case, and of characters outside ASCII. A language keeps those that at
    least ``least_docs`` of its documents have. With p and q the proportions of a term in two groups, their distance is
    floor((p - q)**2 / (p + q)). Part ``pair`` sums it over all kept terms against each other source (``item``) of the
    language; part ``term`` has the ten terms that a source uses most above its language as a whole. Ranks count from 1 by
    falling value, ties by item.

    Missing texts, languages and sources are empty ones. A source whose documents have no kept term still has its pairs; a
    language of one source has none. Each row counts as a document, repeated ones too; a very long text is split in
    pieces and takes memory for its distinct terms. An empty table gives no rows; other columns are ignored. Work grows
    with the kept terms times the square of a language's sources, as does the number of pairs returned.
    """
    terms = frozen(term_counts(docs, least_docs), "audit-terms")
    # One row per source: small tables from here on.
    sizes = terms.select("lang", F.inline("entries")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("kept"))
    sources = sizes.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("sources")).join(kept, "lang")
    spread = sources.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    placed = terms.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(SPREAD)).cast("int")).join(spread, ["lang", "part"])
    found = frozen(placed.select("lang", "term", "entries", "sources", "kept").mapInArrow(
        _compared, "lang string, source string, part string, item string, value long"), "audit-sums")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    best = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS)
    return pairs.withColumn("rank", rank).unionByName(best).select("lang", "source", "part", "item", "value", "rank")

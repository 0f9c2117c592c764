"""Personal data in whole texts: exact patterns, and a skip-chain conditional random field that adds what they miss.

The field's nodes are the words with a digit or an at sign; all other words are known to be no personal data. Neighbouring
nodes are linked in a chain, and each node is also linked to the next word of the same form anywhere in the document, so
that distant repeated or similar words (equal but for case and punctuation, or with the same digits) share potentials.
Loopy message passing over both kinds of links gives the label probabilities of a whole document at once.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.shared import hash_sample, only, small_batches
from reelmill.llm.words import raw, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE_DOCS = 20_000  # the field is fitted on about so many documents, labelled by the patterns
SAMPLE_WORDS = 200  # documents of the sample with more nodes are left out
ROUNDS = 12  # of message passing
SLICE = 65_536  # links, or nodes, whose tables are held at once
STEPS = 150
SURE = 0.9  # probability from which a word is reported
CONSISTENCY = 2.0  # what the potential of equal labels on a skip link is drawn to while fitting

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Repeated groups are possessive: nothing follows them, and places to go back to would be kept for each repetition.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^ \t-\r]+")
_NODE = re.compile(r"[0-9@]")

# What a word can show, each a feature of its own.
_SHAPES = tuple((name, re.compile(pattern)) for name, pattern in (
    ("at sign", r"@"), ("address", r"[^@]+@[^@]+\.[A-Za-z]{2,}[.,;:!?)]*$"), ("plus", r"^[(\"']*\+[0-9]"),
    ("bracketed", r"^\([0-9]{2,5}\)[.,;:]*$"), ("group dash group", r"^[0-9]{3}[-.][0-9]{4}[.,;:!?)]*$"),
    ("three groups", r"^\(?[0-9]{2,4}\)?[-.][0-9]{3}[-.][0-9]{4}[.,;:!?)]*$"),
    ("four of four", r"^[0-9]{4}[.,;:]*$"), ("letters", r"[A-Za-z]"), ("fraction", r"^[0-9]+\.[0-9]*[.,;:]*$"),
    ("short number", r"^[0-9]{1,3}[.,;:!?)]*$"), ("mixed", r"[0-9][A-Za-z]|[A-Za-z][0-9]"),
))
FEATURES = (*(name for name, _ in _SHAPES), "ip", "card", "constant")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs: each has to be followed by a domain and led by a local part."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Runs of numbers and dots, taken four numbers at a time."""
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        at = run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in four):
                yield at, at + size
            at += size + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in _DIGITS.finditer(text):
        if 14 <= len(run[0]) - run[0].count(" ") - run[0].count("-") <= 19:
            if luhn(run[0].replace(" ", "").replace("-", "")):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for run in _PHONE.finditer(text):
        if 10 <= sum(x.isdigit() for x in run[0]) <= 15:
            yield run.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches, ordered by start, then kind."""
    found = [(start, k, end) for k, find in enumerate((emails, ips, cards, phones)) for start, end in find(text)]
    return sorted(found)


@dataclass
class Graph:
    """Nodes of one or several documents: ``features`` (node, feature) of 0 and 1, ``given`` (label or -1), links by node
    numbers. A node takes about 60 bytes with its links."""

    features: np.ndarray
    given: np.ndarray
    chain: np.ndarray  # (link, 2)
    skip: np.ndarray
    spans: np.ndarray  # (node, 2): of the words, without punctuation around them


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph:
    """The field over the words of a text; words that a base span covers are given their kind."""
    spans, forms, numbers, given, rows = array("i"), array("Q"), array("i"), array("b"), bytearray()
    at = 0
    for number, word in enumerate(_WORD.finditer(text)):
        if not _NODE.search(word[0]):
            continue
        while at < len(base) and base[at][2] <= word.start():
            at += 1
        inner = word[0].strip(".,;:!?\"'()[]{}<>")
        start = word.start() + max(word[0].find(inner), 0)
        spans.extend((start, start + len(inner)))
        digits = re.sub(r"[^0-9]", "", inner)
        rows += bytes((*(bool(shape.search(word[0])) for _, shape in _SHAPES), any(True for _ in ips(inner)),
                       14 <= len(digits) <= 19 and luhn(digits), True))
        form = digits if len(digits) >= 3 and "@" not in inner else inner.lower()
        forms.append(xxhash.xxh3_64_intdigest(form.encode("utf-8", "surrogatepass")))
        numbers.append(number)
        cover = [k for start, k, end in base[at:at + 4] if start < word.end() and end > word.start()]
        given.append(cover[0] + 1 if cover else -1)
    form, place = np.array(forms, np.uint64), np.array(numbers, np.int32)
    order = np.argsort(form, kind="stable").astype(np.int32)  # nodes of one form side by side, in the text's order
    same = form[order[1:]] == form[order[:-1]]
    first, second = order[:-1][same], order[1:][same]
    apart = place[second] - place[first] > 1
    skip = np.stack([first[apart], second[apart]], axis=1)
    before = np.flatnonzero(np.diff(place) == 1).astype(np.int32)
    return Graph(np.frombuffer(bytes(rows), np.uint8).reshape(-1, len(FEATURES)), np.array(given, np.int8),
                 np.stack([before, before + 1], axis=1), skip[np.argsort(skip[:, 1])], np.array(spans, np.int32).reshape(-1, 2))


def joined(graphs: list[Graph]) -> Graph:
    """Several documents side by side in one field."""
    starts = np.cumsum([0, *(len(g.given) for g in graphs)])
    return Graph(np.concatenate([g.features for g in graphs]), np.concatenate([g.given for g in graphs]),
                 np.concatenate([g.chain + s for g, s in zip(graphs, starts)]),
                 np.concatenate([g.skip + s for g, s in zip(graphs, starts)]), np.concatenate([g.spans for g in graphs]))


@dataclass
class Field:
    """Weights: of a feature for a label, and of two labels on a chain link (first, second) and on a skip link."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def new_field() -> Field:
    k = len(LABELS)
    return Field(np.zeros((len(FEATURES), k)), np.zeros((k, k)), np.eye(k) * CONSISTENCY)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _slices(graph: Graph, field: Field) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of at most ``SLICE`` links, chain links first: their numbers, their nodes, and the potential they share."""
    for links, pair, first in ((graph.chain, field.chain, 0), (graph.skip, field.skip, len(graph.chain))):
        for low in range(0, len(links), SLICE):
            some = links[low:low + SLICE]
            yield slice(first + low, first + low + len(some)), some, pair


def _settled(field: Field, graph: Graph, clamp: bool, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log potentials of nodes with all messages to them, and the messages along and against each link, as ``kind``.

    Messages pass along all links at once, half of each being kept from the round before, which settles loops. Every message
    of a round is made from the last round's alone, so that links can be taken in slices.
    """
    own = np.empty((len(graph.given), len(LABELS)), kind)
    for low in range(0, len(own), SLICE):
        own[low:low + SLICE] = graph.features[low:low + SLICE].astype(np.float64) @ field.node
    if clamp:
        known = np.flatnonzero(graph.given >= 0)
        own[known] = -50.0
        own[known, graph.given[known]] = 50.0
    there = np.zeros((len(graph.chain) + len(graph.skip), len(LABELS)), kind)  # from a link's first node to its second
    back = np.zeros_like(there)

    def total() -> np.ndarray:
        out = own.copy()
        for run, links, _ in _slices(graph, field):
            np.add.at(out, links[:, 1], there[run])
            np.add.at(out, links[:, 0], back[run])
        return out

    for _ in range(ROUNDS if len(there) else 0):
        now = total()
        for run, links, pair in _slices(graph, field):
            new = _log_sum((now[links[:, 0]] - back[run])[:, :, None] + pair, 1)
            old = _log_sum((now[links[:, 1]] - there[run])[:, None, :] + pair, 2)
            there[run] += 0.5 * (new - _log_sum(new, 1)[:, None] - there[run])
            back[run] += 0.5 * (old - _log_sum(old, 1)[:, None] - back[run])
    return total(), there, back


def beliefs(field: Field, graph: Graph, clamp: bool) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of nodes (node, label) and of links (link, label, label), chain links first. For fitting: the tables
    of all links are held."""
    now, there, back = _settled(field, graph, clamp, np.float64)
    both = np.empty((len(there), len(LABELS), len(LABELS)))
    for run, links, pair in _slices(graph, field):
        both[run] = (now[links[:, 0]] - back[run])[:, :, None] + (now[links[:, 1]] - there[run])[:, None, :] + pair
    both = np.exp(both - both.max(axis=(1, 2), keepdims=True)) if len(both) else both
    return np.exp(now - _log_sum(now, 1)[:, None]), both / both.sum(axis=(1, 2), keepdims=True)


def most_likely(field: Field, graph: Graph) -> np.ndarray:
    """Each node's label where the field is sure, given the known ones; 0 elsewhere."""
    now, _, _ = _settled(field, graph, True, np.float32)
    best = np.zeros(len(now), np.int8)
    for low in range(0, len(now), SLICE):
        some = now[low:low + SLICE]
        chance = np.exp(some - _log_sum(some, 1)[:, None])
        best[low:low + SLICE] = np.where(chance.max(axis=1) >= SURE, chance.argmax(axis=1), 0)
    return best


def fit_field(graphs: list[Graph], steps: int = STEPS) -> Field:
    """Maximize the likelihood of the given labels (a word without one counts as none), with message passing for the
    expectations, by Adam."""
    field = new_field()
    if not graphs:
        field.node[-1, 0] = 5.0  # without examples nothing but the patterns is reported
        return field
    graph = joined(graphs)
    labels = np.maximum(graph.given, 0)
    features = graph.features.astype(np.float64)
    links = np.concatenate([graph.chain, graph.skip])
    one = np.eye(len(LABELS))
    weights = (field.node, field.chain, field.skip)
    prior = (0.0, 0.0, np.eye(len(LABELS)) * CONSISTENCY)
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    split = len(graph.chain)
    for step in range(1, steps + 1):
        nodes, pairs = beliefs(field, graph, clamp=False)
        seen = np.zeros_like(pairs)
        seen[np.arange(len(links)), labels[links[:, 0]], labels[links[:, 1]]] = 1
        found = (features.T @ (one[labels] - nodes), (seen - pairs)[:split].sum(axis=0), (seen - pairs)[split:].sum(axis=0))
        for w, g, p, a, b in zip(weights, found, prior, first, second, strict=True):
            g = (g - 0.05 * (w - p)) / len(labels)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w += 0.1 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-9)
    return field


def added_spans(field: Field, graph: Graph, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of neighbouring words that the field is sure about and that overlap no base span."""
    if not len(graph.given):
        return []
    best = most_likely(field, graph)
    best[graph.given >= 0] = 0
    linked = np.zeros(len(best), bool)
    linked[graph.chain[best[graph.chain[:, 0]] == best[graph.chain[:, 1]], 1]] = True
    out: list[tuple[int, int, int]] = []
    for node in np.flatnonzero(best).tolist():
        start, end = graph.spans[node].tolist()
        if linked[node]:
            start = out.pop()[0]
        out.append((start, int(best[node]) - 1, end))
    taken = sorted(base)
    reach = np.maximum.accumulate([x[2] for x in taken]) if taken else np.zeros(0)
    starts = np.array([x[0] for x in taken])
    return [x for x in out if x[0] < x[2] and not (len(taken) and (
        k := int(np.searchsorted(starts, x[2]))) and reach[k - 1] > x[0])]


def with_candidates(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a digit or an at sign; all patterns and nodes need one."""
    text = data[offsets[0]:offsets[-1]]
    hits = np.concatenate([[0], np.cumsum(((text >= 48) & (text <= 57)) | (text == 64))])
    return np.diff(hits[offsets - offsets[0]]) > 0


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Field:
    """Fit the field on about ``sample`` documents (``doc_id``, ``text``), labelled by the patterns.

    At most twice as many documents with up to 200 words with digits or at signs reach the driver, as features only.
    """
    chosen = hash_sample(only(small_batches(docs), {"doc_id": "long", "text": "string"}), sample)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            texts = batch.column("text").take(pa.array(np.flatnonzero(with_candidates(data, offsets)))).to_pylist()
            graphs = [graph_of(text, base_spans(text)) for text in texts]
            graphs = [g for g in graphs if 0 < len(g.given) <= SAMPLE_WORDS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.packbits(g.features.astype(bool)).tobytes() for g in graphs], pa.binary()),
                 *(pa.array([getattr(g, x).ravel().tolist() for g in graphs], pa.list_(pa.int64())) for x in ("given", "chain", "skip"))],
                names=["features", "given", "chain", "skip"])

    ddl = "features binary, given array<long>, chain array<long>, skip array<long>"
    graphs = []
    for row in sorted(chosen.mapInArrow(read, ddl).collect(), key=lambda r: (bytes(r.features), r.given, r.chain, r.skip)):
        bits = np.unpackbits(np.frombuffer(bytes(row.features), np.uint8))[:len(row.given) * len(FEATURES)]
        graphs.append(Graph(bits.reshape(-1, len(FEATURES)), np.array(row.given, np.int64),
                            np.array(row.chain, np.int64).reshape(-1, 2), np.array(row.skip, np.int64).reshape(-1, 2), np.zeros((len(row.given), 2), np.int32)))
    return fit_field(graphs)


def find_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """Documents (``doc_id``, ``text``) with ``base``, the pattern matches, and ``spans``, these and what the field adds:
    arrays of structs (``start``, ``rank`` of the kind, ``kind``, ``end``) ordered by start, then kind, in code points.

    Memory grows with one text: its numbers take about 150 bytes a word while labels are passed, in single precision, the tables
    of links being made in slices. Missing and empty texts have no spans. Every row is answered by its text alone, repeated and missing ids too; an empty
    table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span_ddl = "array<struct<start: int, rank: int, kind: string, end: int>>"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for start, stop in slices(batch.column("text")):
                some = set(np.flatnonzero(with_candidates(data, offsets[start:stop + 1])).tolist())
                base, spans = [], []
                for k in range(stop - start):
                    known, more = [], []
                    if k in some:
                        text = batch.column("text")[start + k].as_py()
                        known = base_spans(text)
                        more = added_spans(shared.value, graph_of(text, known), known)
                    base.append(known)
                    spans.append(sorted(known + more))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), _lists(base), _lists(spans)],
                                                 names=["doc_id", "base", "spans"])

    return only(small_batches(docs), {"doc_id": "long", "text": "string"}).mapInArrow(
        find, f"doc_id long, base {span_ddl}, spans {span_ddl}")


def _lists(rows: list[list[tuple[int, int, int]]]) -> pa.ListArray:
    """Lists of spans as lists of structs."""
    start, rank, end = (pa.array((x[i] for row in rows for x in row), pa.int32()) for i in range(3))
    kind = pa.array(KINDS).take(rank)
    offsets = pa.array(np.cumsum([0, *(len(row) for row in rows)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([start, rank, kind, end], names=["start", "rank", "kind", "end"]))


def count_of(spans: str, kind: str):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")

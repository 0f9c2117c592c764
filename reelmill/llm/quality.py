"""Quality of documents by the votes of their nearest labelled neighbours in a latent space.

A text becomes a bag of forms: the shapes of its words (which classes of characters follow each other, so ``Then,`` and
``Form,`` are one shape), pairs of neighbouring shapes, and how its words repeat. Bags are weighted by the document
frequencies of the whole corpus and projected on the leading singular vectors of a sample of labelled bags. The sample's
vectors are broadcast, and every document is compared with all of them in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.lang_id import remainder
from reelmill.llm.shared import hash_sample, only, small_batches
from reelmill.llm.words import hash_spans, hashes, mix, raw, slices, spans

SAMPLE = 6000  # the bound of the labelled sample: about so many documents, never more than twice as many
BUCKETS = 2048  # forms are hashed to so many features
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 4  # votes weigh the cosine to this power
BLOCK = 512  # documents that are compared at a time
FOLDS = 5  # documents whose id has remainder 0 are held out of the fit
RATIOS = 8  # steps of the share of different words in a text, and of words that repeat the one before
_PAIR, _SAME, _RATIO = (np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)) for k in (3, 5, 7))


def _classes() -> np.ndarray:
    """A class for each byte: one for capitals, one for other letters, one for digits, and each other byte for itself."""
    out = np.arange(256, dtype=np.uint8)
    out[ord("A"):ord("Z") + 1] = ord("A")
    out[ord("a"):ord("z") + 1] = ord("a")
    out[128:] = ord("a")
    out[ord("0"):ord("9") + 1] = ord("0")
    return out


_CLASS = _classes()
_RUNS = np.isin(np.arange(256), [ord("A"), ord("a"), ord("0")])  # classes whose runs count as one


@dataclass
class Model:
    weights: np.ndarray  # (BUCKETS,), inverse document frequencies
    axes: np.ndarray  # (BUCKETS, dimensions)
    vectors: np.ndarray  # (sample, dimensions), of length 1 or 0
    labels: np.ndarray  # (sample,), 0 or 1

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5


def forms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse bags of the texts: document, bucket and count of each form."""
    starts, ends, bounds = spans(data, offsets)
    text = data[offsets[0]:offsets[-1]]
    kinds = _CLASS[text]
    keep = np.ones(len(kinds), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | ~_RUNS[kinds[1:]]
    keep[starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    shape = hash_spans(kinds[keep], place[starts], place[ends])
    word, _ = hashes(data, offsets)
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    follows = owner[1:] == owner[:-1]
    pair = mix(shape[:-1] * _PAIR + shape[1:])[follows]
    same = follows & (word[1:] == word[:-1])
    again = np.bincount(owner[1:][same], minlength=n)
    size = np.diff(bounds)
    order = np.lexsort((word, owner))
    new = np.ones(len(word), bool)
    new[1:] = (np.diff(owner[order]) != 0) | (word[order][1:] != word[order][:-1])
    different = np.bincount(owner[order][new], minlength=n)
    filled = np.flatnonzero(size > 0)
    # Long texts repeat more words, so the share is set against the square root of the length.
    ratio = np.clip(np.log2(np.maximum(different[filled], 1) / np.sqrt(size[filled])) + RATIOS / 2, 0, RATIOS - 1).astype(np.uint64)
    some = np.flatnonzero(again)
    share = np.ceil(RATIOS * again[some] / size[some]).astype(np.uint64)
    documents = np.concatenate([owner, owner[1:][follows], filled, some])
    hashed = np.concatenate([shape, pair, mix(ratio + _RATIO), mix(share + _SAME)])
    weight = np.concatenate([np.ones(len(owner) + len(pair), np.int64), size[filled] // 4 + 1, again[some] + 1])
    cell = documents * BUCKETS + (hashed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    cells, back = np.unique(cell, return_inverse=True)
    return cells // BUCKETS, cells % BUCKETS, np.bincount(back, weights=weight, minlength=len(cells))


def _bags(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    data, offsets = raw(column)
    for start, stop in slices(column):
        for low in range(start, stop, BLOCK):
            high = min(low + BLOCK, stop)
            yield low, high, *forms(data, offsets[low:high + 1])


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents (``text``), and in how many of them each bucket occurs: one pass over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            rows += len(batch)
            for _, _, _, bucket, _ in _bags(batch.column("text")):
                found[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
        found[BUCKETS] = rows
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], names=["bucket", "docs"])

    texts = only(small_batches(docs), {"text": "string"})
    sums = texts.mapInArrow(count, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs")).collect()
    out = np.zeros(BUCKETS + 1, np.int64)
    for row in sums:  # a row for each bucket at most
        out[row.bucket] = row.docs
    return int(out[BUCKETS]), out[:BUCKETS]


def _weighted(count: int, document: np.ndarray, bucket: np.ndarray, times: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Dense rows of length 1 (or 0 for an empty bag)."""
    out = np.zeros((count, BUCKETS), np.float32)
    out[document, bucket] = np.log1p(times) * weights[bucket]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> Model:
    """A model of the ``quality`` in ``labels`` (by ``doc_id``) of documents (``doc_id``, ``text``).

    The sample is bounded: about ``sample`` of the labels are drawn by a hash of the id, and if their ids stand for more
    documents than that, about so many of these. Labels without an id, or other than 0 and 1, are not used; a document with
    several labels counts with each. Document frequencies come from all documents.
    """
    marks = only(labels, {"doc_id": "long", "quality": "int"}).where("doc_id is not null and quality in (0, 1)")
    drawn = hash_sample(marks, sample)
    texts = only(small_batches(docs), {"doc_id": "long", "text": "string"}).join(F.broadcast(drawn), "doc_id")
    bags = texts.withColumn("text_id", F.xxhash64("text"))

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("quality").to_numpy()
            for low, high, document, bucket, times in _bags(batch.column("text")):
                cuts = np.searchsorted(document, np.arange(high - low + 1))
                parts = [pa.array([a[x:y].tolist() for x, y in zip(cuts[:-1], cuts[1:])], pa.list_(pa.int64()))
                         for a in (bucket, times.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), pa.array(label[low:high]), *parts],
                                                 names=["doc_id", "quality", "bucket", "times"])

    chosen = hash_sample(bags, sample, "text_id").select("doc_id", "text", "quality")
    rows = chosen.mapInArrow(bag, "doc_id long, quality int, bucket array<long>, times array<long>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.quality, r.bucket, r.times))
    total, found = frequencies(docs)
    weights = np.log((1 + total) / (1 + found)).astype(np.float32) + np.float32(0.1)
    owner = np.repeat(np.arange(len(rows)), [len(r.bucket) for r in rows])
    dense = _weighted(len(rows), owner, np.array([b for r in rows for b in r.bucket], np.int64),
                      np.array([t for r in rows for t in r.times], np.float64), weights)
    # The leading right singular vectors of the sample, from its Gram matrix.
    _, vectors = np.linalg.eigh((dense.T @ dense).astype(np.float64))
    axes = np.ascontiguousarray(vectors[:, ::-1][:, :dimensions], np.float32)
    return Model(weights, axes, _unit(dense @ axes), np.array([r.quality for r in rows], np.float32))


def vote(model: Model, vectors: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """The mean label of each vector's nearest neighbours, weighted by a power of the cosine; without a neighbour of positive
    cosine the mean of all labels."""
    if not len(model.labels):
        return np.full(len(vectors), model.prior)
    near = vectors @ model.vectors.T
    k = min(neighbours, near.shape[1])
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.clip(np.take_along_axis(near, best, axis=1), 0, 1).astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    return np.where(total > 1e-9, (weight * model.labels[best]).sum(axis=1) / np.maximum(total, 1e-9), model.prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Documents (``doc_id``, ``text``) with ``score``, how likely their quality is 1.

    Texts are read whole. A missing text is an empty one; texts without words get the share of label 1 in the sample, and
    so does every text if there are no labels (then 0.5). Each row is answered by its text alone, repeated and missing ids
    too; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for low, high, document, bucket, times in _bags(batch.column("text")):
                vectors = _unit(_weighted(high - low, document, bucket, times, model.weights) @ model.axes)
                found = np.clip(vote(model, vectors), 0, 1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), pa.array(found)], names=["doc_id", "score"])

    return only(small_batches(docs), {"doc_id": "long", "text": "string"}).mapInArrow(judge, "doc_id long, score double")


def learnable(labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Labels of documents that are not held out."""
    return labels.where(remainder(F.col("doc_id"), folds) != 0)

"""The quality classifier: held-out accuracy, votes against a plain search, and odd inputs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from reelmill.llm import quality
from reelmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    found = {r.doc_id: r for r in QUERIES["op13_quality"](spark, SF).collect()}
    assert len(found) == tables[0].count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    held = [r for r in tables[1].collect() if found[r.doc_id].held_out]
    right = [found[r.doc_id].predicted == r.quality for r in held]
    assert np.mean(right) > 0.96
    good = [found[r.doc_id].predicted for r in held if r.quality == 1]
    assert np.mean(good) > 0.98


def test_held_out_labels_change_nothing(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, quality.learnable(labels))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end"
                               " as quality")
    again = quality.fit(docs, quality.learnable(turned))
    assert np.array_equal(model.labels, again.labels) and np.allclose(model.vectors, again.vectors)


def test_votes_against_plain_search():
    rng = np.random.default_rng(0)
    vectors, labels = quality._unit(rng.normal(size=(200, 6)).astype(np.float32)), rng.integers(0, 2, 200).astype(np.float32)
    model = quality.Model(np.zeros(1), np.zeros((1, 6)), vectors, labels)
    asked = quality._unit(rng.normal(size=(30, 6)).astype(np.float32))
    for x, found in zip(asked, quality.vote(model, asked), strict=True):
        near = sorted(((float(x @ v), float(y)) for v, y in zip(vectors, labels, strict=True)), reverse=True)[:quality.NEIGHBOURS]
        weights = [max(c, 0) ** quality.SHARPNESS for c, _ in near]
        assert found == pytest.approx(sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights), abs=1e-4)


def test_frequencies_cover_all_documents(tables):
    docs, _ = tables
    total, found = quality.frequencies(docs)
    expected = np.zeros(quality.BUCKETS, np.int64)
    for row in docs.collect():
        data, offsets = quality.raw(pa.array([row.text]))
        expected[quality.forms(data, offsets)[1]] += 1
    assert total == docs.count() and np.array_equal(found, expected)


def test_shapes():
    def bag(text):
        _, bucket, times = quality.forms(*quality.raw(pa.array([text])))
        return dict(zip(bucket.tolist(), times.tolist(), strict=True))

    assert bag("Then, form") == bag("Dort, hände") != bag("THEN, form")
    assert bag("") == {} and bag(" \n\t") == {}


def test_odd_rows(odd_rows, spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (5, 0, 0), (6, 0, 1), (9, 0, 0), (10, None, 0), (None, 1, 0), (99, 1, 0), (7, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(odd_rows, labels)
    assert len(model.labels) == 1 + 2 + 2 + 1
    found = quality.score(odd_rows, model).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((r.doc_id for r in odd_rows.collect()), key=str)
    prior = model.prior
    assert all(r.score == pytest.approx(prior) for r in found if r.doc_id in (1, 2, 3))
    by_text = {(r.doc_id, r.score) for r in found if r.doc_id == 7}
    assert len(by_text) == 1
    assert quality.score(odd_rows.where("false"), model).collect() == []


def test_without_labels_or_documents(odd_rows, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(odd_rows, none)
    assert {r.score for r in quality.score(odd_rows, model).collect()} == {0.5}
    assert len(quality.fit(odd_rows.where("false"), none).labels) == 0

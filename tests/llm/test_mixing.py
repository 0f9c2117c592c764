from __future__ import annotations

import random

import pytest
from brute import targets, words
from reelmill.llm import mixing


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, None: 300}, {"é": 1, "Z": 2, "a": 40_000, "z": 3, "b": 0},
    {None: 7}, {f"s{i:02d}": (i * 37) % 11 * 100 + 1 for i in range(20)}, {"a": 0, "b": 0},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(rows).collect()}
    expected = targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert found == pytest.approx(expected)


@pytest.fixture
def corpus(prose):
    rng = random.Random(2)
    sources = ["a", "b", "c", "é", None]
    return [(i, prose(rng.choice([1, 30, 200])) if i % 9 else None, "en", rng.choices(sources, [60, 2, 20, 10, 8])[0]) for i in range(600)]


def test_mix(documents, corpus):
    rows = mixing.mix_sources(documents(corpus)).collect()
    sizes: dict = {}
    for _, text, _, source in corpus:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    goal, of = targets(sizes), {i: source for i, _, _, source in corpus}
    taken: dict = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.size == len(words(corpus[r.doc_id][1])) and r.source_size == sizes[of[r.doc_id]]
        assert r.target == pytest.approx(goal[of[r.doc_id]]) and 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[of[r.doc_id]] += r.taken
    for source, words_ in taken.items():
        assert abs(words_ - goal[source]) <= 100, source  # half of the longest document
    again = mixing.mix_sources(documents(corpus[::-1])).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mixed_documents(documents, corpus):
    rows = mixing.mix_sources(documents(corpus)).collect()
    out = mixing.mixed_documents(documents(corpus))
    assert out.columns == documents(corpus).columns
    count: dict = {}
    for r in out.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {r.doc_id: r.taken // r.size for r in rows if r.taken}


def test_rows_without_ids_are_decided_one_by_one(documents, prose):
    """Five hundred rows that share no id come within one document of their target."""
    rows = [(None, prose(10), "en", "a") for _ in range(500)] + [(4, prose(10), "en", "a") for _ in range(100)]
    rows += [(k, prose(30), "en", "b") for k in range(300)] + [(1000 + k, prose(10), "en", "c") for k in range(300)]
    found = mixing.mix_sources(documents(rows)).collect()
    target = next(r.target for r in found if r.source_size == 6000)
    assert abs(sum(r.taken for r in found if r.source_size == 6000) - target) <= 10

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import components, shingle_sets, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from reelmill.llm import jaccard_join
from reelmill.llm.components import connected_components
from reelmill.llm.words import hashes, raw


def changed(text: str, edits: int, rng: random.Random) -> str:
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 9)}"
    return " ".join(w)


@pytest.fixture
def corpus(prose):
    """Groups of near and exact copies, chains of copies, a passage in many documents, and unrelated texts."""
    rng = random.Random(3)
    texts: list[str | None] = [prose(rng.randint(5, 120)) for _ in range(60)]
    base = prose(150)
    texts += [changed(base, rng.randint(0, 4), rng) for _ in range(150)]  # more than a block
    chain = prose(120)
    for _ in range(12):
        chain = changed(chain, 2, rng)
        texts.append(chain)
    texts += [texts[3]] * 20 + [texts[5].upper()] * 3
    passage = prose(40)
    texts += [f"{passage} {prose(rng.choice([5, 9, 60]))}" for _ in range(60)]
    texts += ["", None, "one", "One", "one two three four", "  "]
    rng.shuffle(texts)
    return dict(enumerate(texts, 100))


def test_against_brute_force(documents, corpus, many_slices):
    found = jaccard_join.similar_documents(documents(list(corpus.items()))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(corpus)
    sets = shingle_sets(corpus)
    for r in found:
        same = [k for k in sets if sets[k] == sets[r.doc_id] and sets[k]]
        assert r.class_id == min(same, default=r.doc_id)


@pytest.mark.parametrize("percent", [50, 95])
def test_other_thresholds(documents, corpus, percent):
    found = jaccard_join.similar_documents(documents(list(corpus.items())), percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(corpus, percent)


def test_links_without_any_centre(documents, prose, monkeypatch):
    """Where no set passes the test against a centre, the matrix still finds all links."""
    real, calls = jaccard_join._reachable, []
    monkeypatch.setattr(jaccard_join, "_reachable", lambda *a: calls.append(a) or (F.lit(False) if len(calls) == 1 else real(*a)))
    texts = dict(enumerate(t for base in (prose(60), prose(80)) for t in (base, f"{base} end", f"start {base}")))
    found = jaccard_join.similar_documents(documents(list(texts.items()))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(texts)


def test_one_of_each(documents, corpus):
    kept = sorted(r.doc_id for r in jaccard_join.one_of_each(documents(list(corpus.items()))).collect())
    assert kept == sorted(k for k, (_, low) in components(corpus).items() if k == low)


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    links = [*chain, *star, (7, 7), (None, 3), (3, 2), (2, 3)]
    rng.shuffle(links)
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in found} == {*((i, 100) for i in range(100, 161)), *((500 + i, 500) for i in range(80)), (2, 2), (3, 2)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB \n\t\x0b\x1c É日", max_size=40) | st.none(), max_size=6))
def test_words_of_arrow_columns(texts):
    found, bounds = hashes(*raw(pa.array(texts, pa.string())), fold=True)
    expected = [words("".join(c.lower() if c < "\x80" else c for c in t or "")) for t in texts]
    assert np.diff(bounds).tolist() == [len(x) for x in expected]
    names = {}
    for name, value in zip((w for x in expected for w in x), found.tolist(), strict=True):
        assert names.setdefault(name, value) == value
    assert len(set(names.values())) == len(names)

from __future__ import annotations

import random

import pytest
from brute import passages, words
from hypothesis import given, settings
from hypothesis import strategies as st
from reelmill.llm import substring


@pytest.fixture
def corpus(prose):
    rng = random.Random(11)
    shared = [prose(n) for n in (34, 35, 36, 60, 90, 300)]
    texts: list[str | None] = [prose(rng.randint(1, 300)) for _ in range(40)]
    texts += [f"{prose(rng.randint(0, 40))} {rng.choice(shared)} {prose(rng.randint(0, 40))}" for _ in range(80)]
    texts += [f"{prose(20)} {shared[4]} {prose(3)} {shared[4]}", texts[0], texts[0], "ab " * 50, "ab " * 35, "ab " * 34, "", None, " "]
    texts += ["\n".join(shared[5].split()) + "  tail"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("extra", [{}, {"shard_words": 50}, {"most_regions": 2}])
def test_against_brute_force(documents, corpus, many_slices, extra):
    found = substring.drop_repeated_passages(documents(corpus), **extra).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == sorted(passages(corpus))
    split = dict((k, words(t)) for k, t in corpus)
    for r in found:
        spans = [tuple(map(int, x.split(":"))) for x in r.spans.split(",") if x]
        assert sum(b - a for a, b in spans) == r.n_removed and all(b - a >= 35 for a, b in spans)
        assert r.kept == " ".join(w for i, w in enumerate(split[r.doc_id]) if not any(a <= i < b for a, b in spans))


def test_repeated_rows_are_occurrences(documents, prose):
    text = prose(40)
    found = substring.drop_repeated_passages(documents([(1, text), (1, text), (2, prose(40))])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 40), (1, 40), (2, 0)]


def test_rows_without_ids_are_told_apart(documents, prose):
    shared = prose(40)
    texts = [f"{prose(1 + i % 60)} {shared} {prose(i % 7)}" if i % 2 else prose(20 + i % 50) for i in range(900)]
    found = substring.drop_repeated_passages(documents([(None, t) for t in texts])).collect()
    expected = passages(list(enumerate(texts)))
    assert sorted((r.n_words, r.n_removed, r.kept) for r in found) == sorted(x[1:] for x in expected)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=12), st.integers(1, 2)), min_size=1, max_size=4))
def test_matching_statistics(sequences):
    automaton = substring.SuffixAutomaton()
    places: dict[tuple, int] = {}
    for words_, weight in sequences:
        automaton.add(words_, weight)
        for i in range(len(words_)):
            for k in range(i + 1):
                part = tuple(words_[k:i + 1])
                places[part] = places.get(part, 0) + weight
    automaton.finish()
    for words_, _ in sequences:
        expected = [max((i + 1 - k for k in range(i + 1) if places[tuple(words_[k:i + 1])] >= 2), default=0)
                    for i in range(len(words_))]
        assert automaton.statistics(words_) == expected

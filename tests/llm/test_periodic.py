"""Periodic runs against a plain search, as whole documents and as tiles that have to be stitched."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import periodic_row, periodic_runs, planted_words, words
from reelmill.llm import periodic

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def _texts(rng: random.Random, count: int, most: int) -> list[str]:
    """Texts of few different words with repetitions of repetitions, cut off anywhere."""
    out = []
    for _ in range(count):
        parts = []
        while len(parts) < most:
            block = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 13, 40, 97)))]
            if rng.random() < 0.4:
                block = block * rng.randint(2, 6)
            parts += block * rng.choice((1, 1, 2, 4, 5, 9))
        parts = parts[:rng.randint(0, most)]
        out.append(" ".join(parts))
    return out


def _solve(found: list[str]) -> list[tuple]:
    names = {w: k for k, w in enumerate(sorted(set(found)))}
    hashes = periodic.mix(np.array([names[w] for w in found], np.uint64) + np.uint64(1))
    out = periodic.solve(hashes, np.array([0, len(found)]), np.array([[0, 64]]), np.array([False]))
    return sorted(((a, b - a + q, q) for q, a, b in zip(out.period.tolist(), out.start.tolist(), out.stop.tolist())),
                  key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_one_tile(seed):
    for text in _texts(random.Random(seed), 40, 30 * (seed + 1)):
        assert _solve(words(text)) == periodic_runs(words(text))


def test_many_documents_side_by_side():
    texts = [words(t) for t in _texts(random.Random(11), 60, 120)]
    names: dict = {}
    ids = [names.setdefault(w, len(names)) for t in texts for w in t]
    bounds = np.cumsum([0, *map(len, texts)])
    out = periodic.solve(periodic.mix(np.array(ids, np.uint64) + np.uint64(1)), bounds, np.array([[0, 64]] * len(texts)),
                         np.zeros(len(texts), bool))
    found = [[] for _ in texts]
    for t, q, a, b in zip(out.tile.tolist(), out.period.tolist(), out.start.tolist(), out.stop.tolist()):
        found[t].append((a, b - a + q, q))
    assert [sorted(f, key=lambda r: (r[0], r[2])) for f in found] == [periodic_runs(t) for t in texts]


def _rows(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize(("single", "core", "octaves"), [(1 << 13, 1 << 13, 9), (16, 16, 1), (10, 32, 2), (40, 64, 3)])
def test_against_plain_search(documents, single, core, octaves):
    rows = [(k, text) for k, text in enumerate(_texts(random.Random(3), 150, 400))]
    rows += [(900, "x " * 900), (901, "a b a a b a " * 150), (None, "y y y y y y y"), (None, "z z z z z z z z"), (3, rows[4][1]), (3, rows[4][1])]
    found = periodic.find_runs(documents([(i, t, "en", "s") for i, t in rows]), single, core, octaves)
    assert _rows(found) == sorted((periodic_row(i, t) for i, t in rows), key=repr)


def test_long_document_in_tiles(documents, prose):
    """Runs longer than a tile, with periods of several levels, between words that repeat nothing."""
    block = [f"w{k}" for k in range(3000)]
    text = [*[f"u{k}" for k in range(5000)], *block * 5, *["again"] * 20_000, *[f"v{k}" for k in range(700)], *block[:700] * 30]
    rows = [(5, " ".join(text)), (8, prose(20_000))]
    found = {r.doc_id: r for r in periodic.find_runs(documents([(i, t, "en", "s") for i, t in rows])).collect()}
    # id 5 has no planted repetition
    assert planted_words(5, ["a", "b"]) == ["a", "b"]
    assert [tuple(r) for r in sorted(found[5].runs)] == [(5000, 15000, 3000), (20000, 20000, 1), (40700, 21000, 700)]
    assert (found[5].start, found[5].length, found[5].period, found[5].exponent_milli) == (20000, 20000, 1, 20_000_000)


def test_planted_repetition():
    ids = [i for i in range(300) if planted_words(i, list("abcdefghijklmnopqrst")) != list("abcdefghijklmnopqrst")]
    assert ids
    for i in ids:
        letters = list("abcdefghijklmnopqrst")
        assert [letters[k] for k in periodic.planted(i, 20)] == planted_words(i, letters)
    assert periodic.planted(None, 20) is None

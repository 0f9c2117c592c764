"""The audit of sources against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from reelmill.llm import divergence


def plain(rows: list[tuple], least: int) -> list[tuple]:
    """(lang, source, part, item, value, rank) of rows (text, lang, source)."""
    rows = [tuple(x or "" for x in row) for row in rows]
    bags = [(Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))), lang, source)
            for text, lang, source in rows]
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for bag, lang, source in bags:
        docs[lang].update(bag.keys())
        counts[lang, source].update(bag)
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = sorted(s for g, s in counts if g == lang)

        def share(bag, kept=kept):
            total = sum(bag[t] for t in kept)
            return {t: 1 + 10 ** 9 * (bag[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in groups}
        q = share(sum((counts[lang, s] for s in groups), Counter()))

        def far(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            pairs = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, far(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return out


def _audit(documents, rows, least):
    frame = documents([(k, text, lang, source) for k, (text, lang, source) in enumerate(rows)])
    return [tuple(r) for r in divergence.audit_sources(frame, least).collect()]


def _rows(vocabulary):
    rng = random.Random(4)
    names = [*vocabulary[:60], "Ünïcode", "ÉTÉ", "été", "日本", "x1y", "a-b_c", "\U0001f600"]
    rows = []
    for k in range(400):
        some = rng.sample(names, 40)
        rows.append((" ".join(rng.choice(some) + rng.choice(("", ".", "!", " \x00\x7f")) for _ in range(rng.randint(0, 60))),
                     rng.choice(("en", "de", None)), rng.choice(("a", "b", "c", "É", None, "z"))))
    return rows


def test_against_plain_counting(documents, vocabulary):
    rows = _rows(vocabulary)
    assert sorted(_audit(documents, rows, 10)) == sorted(plain(rows, 10))


def test_small_steps_give_the_same(documents, vocabulary, monkeypatch):
    rows = _rows(vocabulary)
    for name, value in (("HELD_TERMS", 30), ("PIECE", 16), ("CELLS", 20), ("OUT_ROWS", 7)):
        monkeypatch.setattr(divergence, name, value)
    batches = list(divergence._counted(iter([divergence.pa.RecordBatch.from_pydict(
        {"lang": ["en"] * 9, "source": ["a", "b", ""] * 3, "text": [r[0] for r in rows[:9]]})])))
    sums = Counter()
    for batch in batches:
        assert len(batch) <= 7
        for row in batch.to_pylist():
            sums[row["source"], row["term"]] += row["n"]
    expected = Counter()
    for k in range(9):
        for term, n in divergence.document_terms(rows[k][0].encode()).items():
            expected[(b"a", b"b", b"")[k % 3], term] += n
    assert +sums == expected


def test_no_kept_term_and_single_sources(documents):
    rows = [("one two", "en", "a"), ("one", "en", "b"), ("... 123", "en", "c"), (None, "de", "only"), ("", None, None)] + \
        [("same words here", "fr", s) for s in "ab" for _ in range(5)]
    assert sorted(_audit(documents, rows, 10)) == sorted(plain(rows, 10))
    assert ("en", "a", "pair", "b", 0, 1) in plain(rows, 10)


def test_empty_table(documents):
    assert divergence.audit_sources(documents([(1, "a", "en", "x")]).where("false")).collect() == []


def test_long_text_in_pieces():
    text = ("Word wörd, " * 300_000 + "x" * 3_000_000).encode()
    assert divergence.document_terms(text) == Counter({b"word": 300_000, "wörd".encode(): 300_000, b"x" * 3_000_000: 1})


@given(st.lists(st.integers(0, 10 ** 12), min_size=1, max_size=8), st.integers(1, 10 ** 9))
def test_proportions_are_exact(counts, kept):
    kept = max(kept, len(counts))
    total = sum(counts)
    found = divergence.proportions(np.array(counts, np.int64), np.int64(total), kept)
    assert found.tolist() == [1 + 10 ** 9 * (c + 2) // (total + 2 * kept) for c in counts]

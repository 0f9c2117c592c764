"""Benchmark items in documents, and nearest neighbours, against exhaustive search."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import edit_distance_inside
from hypothesis import given, settings
from hypothesis import strategies as st
from reelmill.llm import decontaminate, neighbours


@pytest.fixture
def items(prose):
    rng = random.Random(1)
    return {i: prose(rng.randint(10, 50)) for i in range(25)}


def edited(text: str, edits: int, rng: random.Random) -> str:
    w = text.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        w[at:at + 1] = [["other"], [], ["extra", w[at]]][kind] if len(w) > 1 else ["other"]
    return " ".join(w)


def test_against_exhaustive_search(documents, spark, items, prose):
    rng = random.Random(6)
    docs, exact = [], set()
    for i in range(150):
        text = prose(rng.randint(20, 150))
        if i % 3 == 0:
            k = rng.randrange(len(items))
            edits = rng.choice([0, 0, 1, 2])
            part = edited(items[k], edits, rng) if edits else items[k].upper().replace(" ", "\n  ", 3)
            exact |= {(i, k)} if not edits else set()
            text = f"{prose(rng.randint(0, 40))} {part} {text}"
        docs.append((i, text))
    found = decontaminate.find_benchmark(documents(docs), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    truth = {}
    for i, text in docs:
        for k, item in items.items():
            edits = edit_distance_inside(" ".join(item.lower().split()), " ".join(text.lower().split()))
            if edits <= int(decontaminate.EDIT_SHARE * len(item)):
                truth[i, k] = edits
    ours = {(r.doc_id, r.item_id): r.edits for r in found}
    assert exact <= set(ours) <= set(truth)
    assert all(ours[p] == 0 for p in exact) and all(ours[p] == truth[p] for p in ours)
    assert len(ours) >= 0.95 * len(truth)


@pytest.mark.parametrize("words", [(8, 14), (15, 30), (31, 60), (61, 120), (121, 250)])
@pytest.mark.parametrize("share", [0.02, 0.04, 0.08, 0.12])
def test_recall_by_length_and_edits(prose, words, share):
    """Characters replaced, left out and put in at random, by length of the item."""
    rng, chars = random.Random(words[0]), np.random.default_rng(words[1])
    some = [decontaminate.make_item(k, prose(rng.randint(*words))) for k in range(80)]
    index = decontaminate.build_index(some)
    docs = [f"{prose(30)} {decontaminate._edited(item.text, share, chars)} {prose(30)}" for item in some]
    found = decontaminate._matches(index, *decontaminate.raw(pa.array(docs)))
    for (row, k), (edits, _) in found.items():
        assert edits <= some[k].limit and edits == decontaminate.edits_within(some[k].text, " ".join(docs[row].split()))
    assert sum((k, k) in found for k in range(80)) >= 0.9 * 80


def test_short_items_and_scripts_without_spaces(documents, spark, prose):
    tests = {1: "What is the capital of France", 2: "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f\u8bf7\u56de\u7b54\u8fd9\u4e2a\u95ee\u9898\u5427\u3002", 3: "zebra", 4: "What is the capital of France",
             5: "\u6211\u4eec\u5728\u8fd9\u91cc\u8ba8\u8bba\u4e86\u5f88\u591a\u5173\u4e8e\u5386\u53f2\u548c\u79d1\u5b66\u7684\u95ee\u9898\u4ed6\u4eec\u90fd\u5f88\u6709\u8da3\u4f46\u662f\u6ca1\u6709\u4eba\u77e5\u9053\u7b54\u6848\u6240\u4ee5\u8981\u7ee7\u7eed\u5b66\u4e60", 6: "   "}
    docs = [(1, f"{prose(9)} what  IS the\ncapital of france? {prose(5)}"), (2, f"\u524d\u9762{tests[2]}\u540e\u9762"), (3, "a ZEBRA."),
            (4, "zebras and what is the capital of frances"), (5, f"{prose(4)}{tests[5].replace('\u5386\u53f2', '\u6570\u5b66')}{prose(4)}"), (6, None),
            (7, "zebra")]
    found = decontaminate.find_benchmark(documents(docs), spark.createDataFrame(list(tests.items()), "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found.collect()) == [
        (1, 1, 0), (1, 4, 0), (2, 2, 0), (3, 3, 0), (5, 5, 2), (7, 3, 0)]


def test_rows_are_joined_with_single_blanks():
    column = pa.array(["  a \n b ", "", None, "c", " "])
    text, bounds = decontaminate.normal_bytes(*decontaminate.raw(column))
    rows = [text[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert [" ".join(r.split()) for r in rows] == ["a b", "", "", "c", ""] and all("  " not in r.strip() for r in rows)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=12), st.text("abc ", max_size=30))
def test_edit_distance(pattern, text):
    assert decontaminate.edits_within(pattern, text) == edit_distance_inside(pattern, text)
    edits = edit_distance_inside(pattern, text)
    assert decontaminate.may_hold(pattern, text, edits)


def test_pieces_of_a_large_benchmark(documents, spark, items, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_CHARS", 1000)
    docs = documents([(k, f"{prose(30)} {item}") for k, item in items.items()] + [(99, prose(80))])
    found = decontaminate.find_benchmark(docs, spark.createDataFrame(list(items.items()), "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.edits) for r in found.collect()} == {(k, k, 0) for k in items}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, found).collect()] == [99]


@pytest.mark.parametrize("same", [None, 4])
def test_clean_rows_stay_beside_contaminated_ones_of_their_id(documents, spark, prose, same):
    item = prose(30)
    clean = [prose(50) for _ in range(5)]
    docs = documents([(same, t) for t in clean] + [(same, f"{prose(9)} {item}"), (same, None), (9, item)])
    found = decontaminate.find_benchmark(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted((r.text or "") for r in decontaminate.drop_contaminated(docs, found).collect()) == sorted([*clean, ""])


@pytest.mark.parametrize("block", [64, 4096])
def test_recall(spark, many_slices, block):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    vectors = (centres[rng.integers(0, 40, 2000)] + 0.3 * rng.normal(size=(2000, 16))).astype(np.float32)
    vectors[100:400] = vectors[100]  # one very common vector
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = neighbours.nearest_neighbours(rows, 20, 10, block=block).collect()
    wide = vectors.astype(np.float64)
    hits = 0
    by: dict = {}
    for r in found:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == list(range(0, 2000, 20))
    for query, got in by.items():
        got.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 11))
        scores = np.add.reduce(wide * wide[query], axis=1)
        assert all(r.score == scores[r.vec_id] for r in got)
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        order = np.lexsort((np.arange(2000), -scores))
        best = [i for i in order.tolist() if i != query][:10]
        hits += len(set(best) & {r.vec_id for r in got})
    assert hits / (len(by) * 10) >= 0.9
    common = sorted(by[120], key=lambda r: r["rank"])
    ties = [r.vec_id for r in common if 100 <= r.vec_id < 400]
    assert ties == sorted(ties)


def test_balanced_parts():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.normal(size=(64, 8)) + 9 * np.eye(8)[k] for k in range(4)])
    links = neighbours.nearest(vectors, vectors, 5, np.arange(256))
    part = neighbours.balanced_parts(links, 4, rng)
    assert np.bincount(part).tolist() == [64] * 4
    assert (part[np.repeat(np.arange(256), 5)] == part[links.ravel()]).mean() > 0.9

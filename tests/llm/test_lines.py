from __future__ import annotations

import random

import pytest
from brute import words
from pyspark.sql import functions as F
from reelmill.llm import lines


def words_of(line: str) -> int:
    return len(words(line))


def plain(rows):
    """Lines in runs that also occur earlier go: three lines, 20 words in fewer, or the whole text."""
    first: dict = {}
    split = {k: t.split("\n") for k, t in rows if t is not None}

    def runs(w):
        sizes = [words_of(x) for x in w]
        for i in range(len(w)):
            for size in (1, 2, 3):
                if i + size <= len(w) and sum(sizes[i:i + size]) >= (1 if size == 3 else 20):
                    yield i, size, (False, *w[i:i + size])
        if len(w) < 3 and sum(sizes):
            yield 0, len(w), (True, *w)

    for k in sorted(split):
        for i, _, run in runs(split[k]):
            first.setdefault(run, (k, i))
    out = {k: (0, 0, None) for k, t in rows if t is None}
    for k, w in split.items():
        gone = {i + j for i, size, run in runs(w) if first[run] != (k, i) for j in range(size)}
        out[k] = (len(w), len(gone), "\n".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(documents, many_slices, seed):
    rng = random.Random(seed)
    pool = [f"line {i}" for i in range(40)] + ["", " ", "hot line"] * 4 + [f"long {i} " + "w " * n for i, n in enumerate((17, 18, 19, 20, 9, 10, 40))]
    block = [f"shared {i}" for i in range(6)]
    rows: list = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 12)) + (block[rng.randrange(3):] if i % 2 else []))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "same\n" * 20), (203, "\n" * 9), (204, "lone"), (205, "lone"), (206, "lone\n"), (207, "lone\n")]
    rng.shuffle(rows)
    found = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in lines.drop_repeated_lines(documents(rows)).collect()}
    assert found == plain(rows)


def test_short_copies_are_found(documents, prose):
    """Whole texts of one or two lines, and long lines between others."""
    two, one, shared = f"{prose(80)}\n{prose(80)}", prose(5), prose(80)
    rows = [(1, two), (2, two), (3, one), (4, one), (5, f"a\n{shared}\nb"), (6, f"c\n{shared}\nd"), (7, f"{one}\nx\n{one}")]
    found = {r.doc_id: (r.n_removed, r.kept) for r in lines.drop_repeated_lines(documents(rows)).collect()}
    assert found == {1: (0, two), 2: (2, ""), 3: (0, one), 4: (1, ""), 5: (0, rows[4][1]), 6: (1, "c\nd"), 7: (0, rows[6][1])}


def test_few_lines_are_selected(spark, prose):
    """Winnowing thins lines out, and a copied run selects the same line in both places."""
    text = "\n".join(prose(4) for _ in range(3000))
    frame = spark.createDataFrame([(1, 0, 0, text), (2, 0, 0, f"other\n{text}")], "doc_id long, text_id long, copy long, text string")
    picked = frame.select("doc_id", F.explode(lines._selected(F.split("text", "\n"))).alias("s")).select("doc_id", "s.fingerprint").collect()
    own = [[r.fingerprint for r in picked if r.doc_id == k] for k in (1, 2)]
    assert len(own[0]) < 0.6 * 3000 and set(own[0]) <= set(own[1])


@pytest.mark.parametrize("same", [None, 7])
def test_rows_that_share_an_id_are_told_apart(documents, many_slices, same):
    own = [[f"text {i} line {j}" for j in range(9)] for i in range(4)]
    twice = own[0][:3] + ["a", "b", "c", "a", "b", "c"]
    texts = ["\n".join(x) for x in (twice, own[1], own[2], own[2], own[2], own[3])]
    found = lines.drop_repeated_lines(documents([(same, t) for t in texts])).collect()
    expected = [(9, 3, "\n".join(twice[:6])), (9, 0, texts[1]), (9, 0, texts[2]), (9, 9, ""), (9, 9, ""), (9, 0, texts[5])]
    assert sorted((r.n_lines, r.n_removed, r.kept) for r in found) == sorted(expected)


def test_copies_at_the_same_line_of_rows_without_ids(documents):
    run = "one\ntwo\nthree"
    found = lines.drop_repeated_lines(documents([(None, f"{run}\nfour"), (None, f"{run}\nfive"), (1, run)])).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in found) == [(False, 3), (True, 0), (True, 3)]

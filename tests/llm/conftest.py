from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(600)]


@pytest.fixture
def prose(vocabulary):
    """Texts of random words, the same in every run."""
    rng = random.Random(7)

    def make(size: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(size))

    return make


@pytest.fixture
def documents(spark):
    """A documents table, with columns whose names clash with what operators return or use inside."""
    ddl = ("doc_id long, text string, lang string, source string, n_chars long, node long, size int, score double, "
           "component_id long, `row of id` int, gone int, of long, level double")

    def make(rows):
        full = [(*row, *[None] * (5 - len(row)), 1, 2, 0.5, 3, 4, 5, 6, 0.1) for row in rows]
        return spark.createDataFrame(full, ddl)

    return make


@pytest.fixture
def odd_rows(documents, prose):
    """Missing values, empty and blank texts, repeated rows and ids, one very long word and one long text."""
    return documents([
        (1, "", "en", "a"), (2, None, "en", "a"), (None, prose(60), None, None), (None, None, None, None),
        (3, " \n\t ", "en", "b"), (4, "x" * 300_000, "en", "b"), (5, prose(30_000), "en", None),
        (6, prose(50), None, "a"), (6, prose(50), "en", "a"), (7, "short", "en", "a"), (7, "short", "en", "a"),
        (-8, "É é 日本語 \U0001f600 " * 30, "xx", "é"), (9, "1 " * 2000, "en", "a"), (10, "a\n" * 500, "en", "a"),
    ])

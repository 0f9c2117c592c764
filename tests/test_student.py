from __future__ import annotations

import pytest

from reelmill.functions.student import incomplete_beta, two_sided_p
from reelmill.operators.summaries import two_sample_t


@pytest.mark.parametrize("t, df, p", [
    (2.228, 10, 0.05), (12.706, 1, 0.05), (2.042, 30, 0.05), (3.169, 10, 0.01), (1.96, 1e7, 0.05), (0.0, 5, 1.0),
])
def test_against_printed_tables(t, df, p):
    assert two_sided_p(t, df) == pytest.approx(p, abs=5e-5)
    assert two_sided_p(-t, df) == pytest.approx(p, abs=5e-5)


def test_beta_symmetry():
    assert incomplete_beta(2.5, 4.0, 0.3) == pytest.approx(1 - incomplete_beta(4.0, 2.5, 0.7))
    assert incomplete_beta(1, 1, 0.42) == pytest.approx(0.42)


def test_pooled_t(spark):
    df = spark.createDataFrame([(0, v) for v in (1.0, 2.0, 3.0)] + [(1, v) for v in (2.0, 3.0, 4.0)] + [(1, None)], "g int, v double")
    row = two_sample_t(df, "g", "v", 0, 1).first()
    assert (row.n_a, row.n_b, row.df) == (3, 3, 4.0)
    assert row.t == pytest.approx(-1.2247448714)
    assert row.p == pytest.approx(0.2878641347) and row.significant is False


def test_too_few_rows_give_no_p(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0)], "g int, v double")
    row = two_sample_t(df, "g", "v", 0, 1).first()
    assert row.t is None and row.p is None

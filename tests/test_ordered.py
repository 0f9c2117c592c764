"""Order statistics against numpy and pandas, including hot groups."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelmill.operators import ordered
from reelmill.operators.ordered import box_stats, ecdf, order_values
from reelmill.operators.summaries import describe_column, grouped_summary, histogram, multi_summary, quadrant_label


pytestmark = pytest.mark.usefixtures("many_slices")


@pytest.fixture(scope="module")
def data():
    """A third of all rows in one group, a group of copies, a single row, missing values and keys."""
    random.seed(3)
    rows = [("hot", random.gauss(0, 100)) for _ in range(2000)]
    rows += [(f"g{i % 50}", float(i % 7)) for i in range(3000)]
    rows += [("same", 4.0)] * 1000 + [("one", 2.5), ("none", None), ("hot", None), (None, 1.0)]
    return pd.DataFrame(rows, columns=["k", "v"])


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame([(k, None if v != v else v) for k, v in data.itertuples(index=False)], "k string, v double")


def close(a, b):
    return (a is None and (b is None or math.isnan(b))) or a == pytest.approx(b, rel=1e-9, abs=1e-9)


def test_summary_equals_pandas(frame, data):
    expected = data.groupby("k")["v"].agg(["count", "mean", "median", "std", "min", "max"])
    got = {r.k: r for r in grouped_summary(frame, ["k"], "v").collect()}
    assert set(got) == set(expected.index)
    for key, row in expected.iterrows():
        assert all(close(got[key][name], row[name]) for name in expected.columns), (key, got[key], row)


def test_quartiles_equal_numpy(frame, data):
    got = order_values(frame, ["k"], ["v"]).statistics({"a": 0.1, "b": 0.25, "c": 0.999, "lo": 0.0, "hi": 1.0})
    for r in got.collect():
        values = data[data.k == r.k].v.dropna()
        if len(values):
            expected = np.quantile(values, [0.1, 0.25, 0.999, 0, 1])
            assert [r.a, r.b, r.c, r.lo, r.hi] == pytest.approx(list(expected))


def test_buckets_never_fall(spark):
    rng = random.Random(1)
    powers = [x for e in range(-1074, 1024, 7) for x in (2.0 ** e, math.nextafter(2.0 ** e, 0), math.nextafter(2.0 ** e, math.inf))]
    values = [*powers, *(-x for x in powers), *(rng.gauss(0, 10 ** rng.randint(-300, 300)) for _ in range(3000)),
              0.0, -0.0, math.inf, -math.inf, 1.7976931348623157e308, 5e-324, 1.0, 2.0, 3.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered._bucket(F.col("v")).alias("b")).collect()
    places = [r.b for r in sorted(rows, key=lambda r: r.v)]
    assert places == sorted(places)
    assert spark.sql("select double('nan') as v").select(ordered._bucket(F.col("v"))).first()[0] > places[-1]


@pytest.mark.parametrize(("rows", "cells"), [(1, 2), (20, 3), (500, 4096)])
def test_large_buckets_are_cut_again(frame, data, monkeypatch, rows, cells):
    """The same results if every interval has to be cut, down to single values."""
    monkeypatch.setattr(ordered, "TASK_ROWS", rows)
    monkeypatch.setattr(ordered, "CELLS", cells)
    probs = {"a": 0.1, "b": 0.5, "c": 0.999}
    for r in order_values(frame, ["k"], ["v"]).quantiles(probs).collect():
        assert [r.a, r.b, r.c] == pytest.approx(list(np.quantile(data[data.k == r.k].v.dropna(), list(probs.values()))))
    values = data.v.dropna()
    found = ecdf(frame, "v").collect()
    assert len(found) == values.nunique() and all(r.share == pytest.approx((values <= r.v).mean()) for r in found)


def test_odd_numbers(spark):
    """Infinite values and NaN have their places at the ends."""
    df = spark.createDataFrame([(x,) for x in (math.inf, -math.inf, 1.0, 1.0, -0.0, 0.0, math.nan)], "v double")
    shares = {str(r.v): round(r.share * 7) for r in ecdf(df, "v").collect()}
    assert shares == {"-inf": 1, "0.0": 3, "1.0": 5, "inf": 6, "nan": 7}
    assert order_values(df, [], ["v"]).quantiles({"m": 0.5}).first()["m"] == 1.0


def test_a_median_changes_no_other_statistic(spark):
    """Sums and extremes keep the column's type and all digits, with a median in the list or not."""
    big = 2 ** 53
    rows = spark.createDataFrame([("a", big), ("a", big + 1), ("a", big + 2), (None, 1)], "k string, v long")
    plain = multi_summary(rows, ["k"], {"v": ["sum", "min", "max", "count"]}).first()
    both = multi_summary(rows, ["k"], {"v": ["sum", "median", "min", "max", "count"]}).first()
    assert (both.v_sum, both.v_min, both.v_max, both.v_count) == tuple(plain)[1:] == (3 * big + 3, big, big + 2, 3)
    whole = multi_summary(rows, [], {"v": ["median", "count"]}).first()
    assert whole.v_count == 4 and whole.v_median == pytest.approx(big)


def test_box(frame, data):
    got = {r.k: r for r in box_stats(frame, ["k"], "v").collect()}
    values = data[data.k == "hot"].v.dropna()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    hot = got["hot"]
    assert (hot.whisker_low, hot.whisker_high, hot.outliers) == (inside.min(), inside.max(), len(values) - len(inside))
    assert got["none"].whisker_low is None and got["none"].outliers == 0


def test_ecdf_is_cume_dist(frame, data):
    values = data.v.dropna()
    for r in ecdf(frame, "v").collect():
        assert r.share == pytest.approx((values <= r.v).mean())


def test_describe(frame, data):
    got, expected = describe_column(frame, "v").first(), data.v.describe()
    assert [got[n] for n in ("count", "mean", "std", "min", "q1", "median", "q3", "max")] == pytest.approx(list(expected))


def test_multi_summary_names_and_values(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 3, 30.0), ("b", 5, None)], "k string, x int, y double")
    row = {r.k: r for r in multi_summary(df, ["k"], {"x": ["median", "count"], "y": ["sum", "std"]}).collect()}
    assert (row["a"].x_median, row["a"].x_count, row["a"].y_sum) == (2.0, 2, 40.0)
    assert (row["b"].x_median, row["b"].y_sum, row["b"].y_std) == (5.0, None, None)


def test_unknown_statistic(frame):
    with pytest.raises(ValueError):
        multi_summary(frame, ["k"], {"v": ["mode"]})


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert grouped_summary(empty, ["k"], "v").count() == 0
    assert ecdf(empty, "v").count() == 0
    assert histogram(empty, "v", 5).count() == 0


def test_histogram_equals_numpy(frame, data):
    counts, edges = np.histogram(data[data.k == "hot"].v.dropna(), bins=20)
    got = histogram(frame.filter("k = 'hot'"), "v", 20).orderBy("bin").collect()
    assert [r.n for r in got] == list(counts)
    assert [r.bin_low for r in got] == pytest.approx(list(edges[:-1]))
    assert sum(r.n for r in histogram(frame, "v", 30, by=["k"]).collect()) == data.dropna().shape[0]


def test_histogram_of_one_value_and_density(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "v double")
    got = histogram(df, "v", 2, density=True).orderBy("bin").collect()
    assert [(r.bin_low, r.bin_high, r.n, r.density) for r in got] == [(3.5, 4.0, 0, 0.0), (4.0, 4.5, 3, 2.0)]


def test_quadrants(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 3.0), ("c", 3.0, 2.0)], "g string, x double, y double")
    got = {r.g: r.q for r in quadrant_label(df, "x", "y", "q", ("hh", "hl", "lh", "ll")).collect()}
    assert got == {"a": "ll", "b": "hh", "c": "hh"}


def test_the_plan_has_no_percentile_and_no_single_task_sort(frame):
    plan = grouped_summary(frame, ["k"], "v")._jdf.queryExecution().toString()
    assert "percentile" not in plan and "SinglePartition" not in plan


def test_the_median_row_meets_its_own_median(spark):
    """Means whose last digit depends on the order of summation must not move the median row."""
    df = spark.range(0, 30000, 1, 7).selectExpr("id % 15 as g", "rand(5) * 0.1 + id % 15 * 1e-9 as v")
    stats = df.groupBy("g").agg(F.avg("v").alias("x"), F.avg(F.col("v") * 3).alias("y"))
    for _ in range(2):
        counts = {r.q: r["count"] for r in quadrant_label(stats, "x", "y", "q", ("hh", "hl", "lh", "ll")).groupBy("q").count().collect()}
        assert counts.get("hh", 0) + counts.get("hl", 0) == 8
        assert counts.get("hh", 0) + counts.get("lh", 0) == 8


def test_histogram_of_given_bounds_leaves_values_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("a", 9.0), ("b", 50.0)], "k string, v double")
    got = {(r.k, r.bin): r.n for r in histogram(df, "v", 2, by=["k"], lo=0, hi=8).collect()}
    assert got == {("a", 0): 1, ("a", 1): 1, ("b", 0): 0, ("b", 1): 0}
    got = {(r.k, r.bin): r.n for r in histogram(df, "v", 2, by=["k"], lo=3).collect()}
    assert got == {("a", 0): 1, ("a", 1): 1, ("b", 0): 0, ("b", 1): 1}

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelmill.functions import columns as C
from reelmill.operators import shaping as S


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("12",), ("12.7",), ("x",), (None,), ("",), ("99999999999",), (" 5 ",)], "v string")
    assert [r.v for r in S.cast_columns(df, {"v": "int"}).collect()] == [12, 12, None, None, None, None, 5]


def test_cast_to_double_and_boolean(spark):
    df = spark.createDataFrame([("7.1", "1"), ("abc", "0"), (None, "yes")], "r string, f string")
    out = S.cast_columns(df, {"r": "double", "f": "boolean"}).collect()
    assert [(r.r, r.f) for r in out] == [(7.1, True), (None, False), (None, None)]


def test_markup_and_null(spark):
    df = spark.createDataFrame([('["Self","Host"]',), (None,)], "c string")
    assert [r.c for r in S.strip_list_markup(df, "c").collect()] == ["Self,Host", None]


def test_null_marker_filter(spark):
    df = spark.createDataFrame([("a", "b"), ("\\N", "b"), ("a", None)], "x string, y string")
    assert S.null_marker_filter(df, ["x", "y"]).count() == 1


def test_left_closed_edges(spark):
    df = spark.createDataFrame([(0,), (29,), (30,), (119,), (120,), (None,)], "m int")
    out = S.bucket_left_closed(df, "m", [30, 60, 90, 120], ["a", "b", "c", "d", "e"], "k")
    assert [r.k for r in out.collect()] == ["a", "a", "b", "d", "e", None]


def test_right_closed_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (3.0,), (3.1,), (10.0,), (10.1,), (None,)], "m double")
    out = S.bucket_right_closed(df, "m", [0, 3, 5, 7, 10], ["p", "f", "g", "e"], "k")
    assert [r.k for r in out.collect()] == [None, "p", "p", "f", "e", None, None]


def test_bucket_labels_have_to_fit():
    with pytest.raises(ValueError):
        C.right_closed_bucket(F.lit(1), [1, 2], ["a", "b"])


def test_scalar_functions(spark):
    one = spark.range(1).select(
        C.decade(F.lit(1999)).alias("decade"),
        C.log_measure(F.lit(0.0)).alias("log0"),
        C.percentage(F.lit(1), F.lit(0)).alias("pct0"),
        C.weighted_score(F.lit(2.0), F.lit(99)).alias("score"),
        C.text_or(F.lit(None).cast("string"), "Unknown").alias("text"),
        F.size(C.split_to_array(F.lit(None).cast("string"))).alias("none"),
        C.labelled(F.lit(3), {0: "no", 1: "yes"}).alias("unmapped"),
        C.labelled(F.lit(3), {0: "no"}, "other").alias("other"),
    ).first()
    assert tuple(one) == (1990, None, None, 4.0, "Unknown", 0, None, "other")


def test_open_ranges(spark):
    df = spark.range(10)
    assert S.range_filter(df, {"id": (3, None)}).count() == 7
    assert S.range_filter(df, {"id": (None, 3)}).count() == 4

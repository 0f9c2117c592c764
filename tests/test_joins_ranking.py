from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelmill.operators import joins as J
from reelmill.operators import profile as P
from reelmill.operators import ranking as R
from reelmill.operators.chunks import _numbered_copies, assign_chunks, chunk_manifest, dataset_manifest, number_rows, total_manifest

pytestmark = pytest.mark.usefixtures("many_slices")


def test_lookup_keeps_rows_and_default(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "id int, name string")
    assert rows(J.lookup_default(df, dim, "k", "id", "name", "Unknown", "who")) == [(1, "b"), (2, "Unknown"), (None, "Unknown")]


def test_left_renamed_keys_fans_out(spark, rows):
    works = spark.createDataFrame([("t1", "p1"), ("t2", "p1")], "tconst string, person_id string")
    roles = spark.createDataFrame([("t1", "p1", "actor"), ("t1", "p1", "writer")], "tconst string, nconst string, category string")
    out = J.left_renamed_keys(works, roles, {"tconst": "tconst", "person_id": "nconst"})
    assert out.columns == ["tconst", "person_id", "category"]
    assert rows(out) == [("t1", "p1", "actor"), ("t1", "p1", "writer"), ("t2", "p1", None)]


def test_salted_left_join_is_a_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, v string")
    right = spark.createDataFrame(
        [(1, "x")] * 200 + [(1, "y")] * 3 + [(2, "z")] + [(i, "q") for i in range(10, 60)] + [(None, "n")], "k int, w string")
    plain, salted = J.left_on_key(left, right, "k"), J.left_on_key(left, right, "k", skewed=True, task_rows=20)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    two = J.left_on_composite(left.withColumn("j", F.lit(1)), right.withColumn("j", F.lit(1)), ["k", "j"], skewed=True)
    assert two.count() == plain.count()
    assert rows(J.left_on_key(left, right.limit(0), "k", skewed=True)) == rows(J.left_on_key(left, right.limit(0), "k"))


def test_orphans_ignore_missing_keys(spark, rows):
    child = spark.createDataFrame([("e1", "t1"), ("e2", "t9"), ("e3", None)], "e string, parent string")
    parent = spark.createDataFrame([("t1",)], "tconst string")
    assert rows(J.orphan_keys(child, parent, "parent", "tconst").select("e")) == [("e2",)]


def test_detail_lookup(spark):
    keys = spark.createDataFrame([(1,), (3,), (3,)], "p int")
    facts = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, None, 3), (2, "z", 9)], "p int, c string, d int")
    found = sorted(map(tuple, J.detail_lookup(keys, facts, "p", ["c", "d"]).collect()))
    assert found == [(1, ["a", "b"], ["2", "3"]), (3, [], [])]


def test_missing_values_rank_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 1.0)], "k string, v double")
    assert [r.k for r in R.top_n(df, "v", 3, desc=False).collect()] == ["c", "b", "a"]
    assert [r.k for r in R.top_n(df, "v", 3).collect()] == ["b", "c", "a"]


def test_extremes_break_ties_by_key(spark, rows):
    df = spark.createDataFrame([("x", "m2", 9), ("x", "m1", 9), ("x", "m3", 1), ("y", "m4", None)], "g string, k string, v int")
    assert rows(R.arg_extreme(df, "v", ["g"], ["k"])) == [("x", "m1", 9)]
    assert rows(R.arg_extreme(df, "v", tie=["k"], largest=False)) == [("x", "m3", 1)]
    assert rows(R.arg_extreme(df, "k")) == [("y", "m4", None)] and rows(R.arg_extreme(df, "k", largest=False)) == [("x", "m1", 9)]
    least = spark.createDataFrame([("a", -2 ** 63), ("b", 0)], "k string, v long")
    assert rows(R.arg_extreme(least, "v", largest=False)) == [("a", -2 ** 63)] and rows(R.arg_extreme(least, "v")) == [("b", 0)]
    assert rows(R.arg_extremes(df, "v", ["g"], ["k"], ("hi", "lo"))) == [("hi", "x", "m1", 9), ("lo", "x", "m3", 1)]


def test_sample_does_not_depend_on_partitioning(spark, rows):
    df = spark.range(20000)
    first = rows(R.sample_rows(df.repartition(3), 500, 42, ["id"]))
    assert len(first) == 500
    assert first == rows(R.sample_rows(df.repartition(7, "id"), 500, 42, ["id"]))
    assert first != rows(R.sample_rows(df, 500, 43, ["id"]))
    assert R.sample_rows(df.limit(10), 500, 42, ["id"]).count() == 10


def test_reorder_fill(spark):
    df = spark.createDataFrame([("b", 5), ("z", 7)], "k string, n long")
    assert [tuple(r) for r in R.reorder_fill(df, "k", ["a", "b"], {"n": 0}).orderBy("position").collect()] == [("a", 1, 0), ("b", 2, 5)]


def test_row_numbers_with_many_copies(spark):
    copies = spark.range(3000).selectExpr("case when id < 1500 then 7 else id end as v", "'same' as t")
    numbered = number_rows(copies, ["v"]).orderBy("row_number").collect()
    assert [r.row_number for r in numbered] == list(range(1, 3001))
    assert [r.v for r in numbered] == sorted(r.v for r in numbered)


def test_chunks(spark):
    chunked = assign_chunks(spark.range(1050).repartition(5), ["id"], 100)
    manifest = chunk_manifest(chunked).orderBy("chunk").collect()
    assert [r.rows for r in manifest] == [100] * 10 + [50]
    assert (manifest[3].start_row, manifest[3].end_row, manifest[-1].end_row) == (300, 399, 1049)
    assert tuple(dataset_manifest(chunked, "ids").first()) == ("ids", 1050, 1, 11, 95)


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert tuple(P.duplicate_keys(df, ["a", "b"]).first()) == (5, 3, 2)
    assert tuple(P.duplicate_keys(df.limit(0), ["a"]).first()) == (0, 0, 0)


def test_distribution_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in P.distribution(df, "k").collect()] == [("a", 2), (None, 1)]
    assert [tuple(r) for r in P.distribution(df, "k", drop_null_keys=True).collect()] == [("a", 2)]
    assert P.distribution_share(df, "k").first().pct == 100.0


def test_heavy_keys_are_counted_exactly(spark):
    rows = spark.range(40_000).selectExpr("case when id % 3 = 0 then -7 else id end as k", "cast(id % 2 as string) as j")
    assert sorted(map(tuple, J.heavy_keys(rows, ["k"], 100).collect())) == [(-7, 13334)]
    assert sorted(map(tuple, J.heavy_keys(rows, ["k", "j"], 100).collect())) == [(-7, "0", 6667), (-7, "1", 6667)]
    assert J.heavy_keys(rows.limit(0), ["k"], 100).collect() == []


def test_copies_are_numbered_alike_in_every_run(spark):
    rows = spark.createDataFrame([(1, "a")] * 500 + [(2, "b")] * 2 + [(k, "c") for k in range(3, 300)] + [(None, None)] * 3, "k int, v string")
    copies = _numbered_copies(rows).groupBy("k", "v").agg(F.count("*").alias("n"), F.count_distinct("_copy").alias("d"), F.max("_copy").alias("m"))
    assert all(r.n == r.d == r.m + 1 for r in copies.collect())
    for _ in range(2):
        numbered = number_rows(rows, ["k"]).collect()
        assert sorted(r.row_number for r in numbered) == list(range(1, 803))
        assert [r.k for r in sorted(numbered, key=lambda r: r.row_number)] == sorted((r.k for r in rows.collect()), key=lambda k: (k is not None, k))


def test_total_manifest(spark):
    chunked = {"a": assign_chunks(spark.range(1050).toDF("k"), ["k"], 100), "b": assign_chunks(spark.range(10).toDF("k"), ["k"], 100)}
    assert sorted(map(tuple, total_manifest(chunked).collect())) == [("a", 1050, 11, 95), ("b", 10, 1, 10), ("total", 1060, 12, 88)]

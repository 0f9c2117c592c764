from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelmill.operators.lists import NO_PEOPLE, attach_list, element_frequencies, explode_list, format_counts

TEXTS = [(1, "Drama, Comedy"), (2, "Drama,,Comedy"), (3, None), (4, ""), (5, "\\N"), (6, "A,")]


def exploded(spark, **options):
    df = spark.createDataFrame(TEXTS, "k int, v string")
    return sorted(tuple(r) for r in explode_list(df, ["k"], "v", "e", **options).collect())


def test_plain_keeps_blanks_and_empties(spark):
    assert exploded(spark) == [(1, " Comedy"), (1, "Drama"), (2, ""), (2, "Comedy"), (2, "Drama"), (5, "\\N"), (6, ""), (6, "A")]


def test_strict_drops_empties(spark):
    assert exploded(spark, trim=True, drop_empty=True, skip=("", "\\N")) == [
        (1, "Comedy"), (1, "Drama"), (2, "Comedy"), (2, "Drama"), (6, "A")]


def test_people_keep_empties(spark):
    assert exploded(spark, trim=True, skip=NO_PEOPLE) == [
        (1, "Comedy"), (1, "Drama"), (2, ""), (2, "Comedy"), (2, "Drama"), (4, ""), (6, ""), (6, "A")]


def test_separator_is_literal(spark):
    df = spark.createDataFrame([(1, "a|b.c")], "k int, v string")
    assert explode_list(df, ["k"], "v", "e", sep="|").count() == 2
    assert explode_list(df, ["k"], "v", "e", sep=".").count() == 2
    assert explode_list(df, ["k"], "v", "e", sep="|b.").count() == 2
    assert explode_list(df, ["k"], "v", "e", sep="\\").count() == 1


def test_two_children_do_not_multiply(spark):
    parent = spark.createDataFrame([("t1",), ("t2",)], "tconst string")
    directors = spark.createDataFrame([("t1", "d1"), ("t1", "d2")], "tconst string, d string")
    writers = spark.createDataFrame([("t1", "w3"), ("t1", "w1"), ("t1", "w2")], "tconst string, w string")
    lists = {"ds": (directors, ["tconst"], "d"), "ws": (writers, ["tconst"], "w")}
    with_null = {r.tconst: (r.ds, r.ws) for r in attach_list(parent, lists).collect()}
    assert with_null == {"t1": (["d1", "d2"], ["w1", "w2", "w3"]), "t2": (None, None)}
    with_empty = {r.tconst: r.ds for r in attach_list(parent, lists, empty="array").collect()}
    assert with_empty == {"t1": ["d1", "d2"], "t2": []}


def test_distinct_lists(spark):
    parent = spark.createDataFrame([(1,)], "k int")
    child = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None)], "k int, v string")
    assert attach_list(parent, {"vs": (child, ["k"], "v")}, distinct=True).first().vs == ["a", "b"]
    assert attach_list(parent, {"vs": (child, ["k"], "v")}).first().vs == ["a", "b", "b"]


def test_format_counts(spark):
    df = spark.createDataFrame([("x", "Drama,Comedy"), ("x", "Drama"), ("x", "Action"), ("y", "War")], "k string, g string")
    counts = element_frequencies(df, "g", by=["k"], out="g2")
    texts = {r.k: r.summary for r in format_counts(counts, ["k"], "g2", "n", 2).collect()}
    assert texts == {"x": "Drama(2), Action(1)", "y": "War(1)"}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text("abc ", min_size=1, max_size=3), max_size=4), min_size=1, max_size=5))
def test_explode_then_attach_gives_the_lists_back(spark, lists):
    data = [(i, ",".join(values)) for i, values in enumerate(lists)]
    parent = spark.createDataFrame(data, "k int, v string")
    child = explode_list(parent, ["k"], "v", "e")
    back = {r.k: r.es for r in attach_list(parent, {"es": (child, ["k"], "e")}, empty="array").collect()}
    assert back == {i: sorted(values) for i, values in enumerate(lists)}

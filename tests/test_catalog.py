"""The catalog jobs on small dumps with every kind of odd row."""

from __future__ import annotations

import gzip

import pytest

from reelmill.plans import catalog as C
from reelmill.plans.talent import originals, person_stats, rated_works, talent_by_consistency, talent_by_rating
from reelmill.plans.talent import talent_weighted, weighted_works
from reelmill.plans.views import content_performance, data_quality_report
from reelmill.schemas import KEYS, RAW, curated_schema
from reelmill.sources.readers import read_delimited

N = "\\N"
BASICS = [
    ("t1", "movie", '"Quoted start', "Plain", "0", "1999", N, "90", "Drama,Comedy"),
    ("t2", "movie", "Blank list", "Plain", "1", "2030", "2031", "-5", "Drama, Comedy"),
    ("t3", "tvSeries", "Hole", N, "2", "abc", N, "x", "Drama,,Comedy"),
    ("t3", "tvSeries", "Again", N, "0", N, N, N, N),
    ("t4", "short", "", "One", "0", "2001", N, "12", "War"),
]
RATINGS = [("t1", "7.1", "100"), ("t2", "10.5", "-3"), ("t3", "bad", N)]
CREW = [("t1", "d1,d2", "w1,w2,w3"), ("t2", N, N), ("t3", "d1", "d1")]
EPISODES = [("e1", "t3", "1", "2"), ("e2", "t9", "-1", "x"), ("e3", "t3", N, "-4")]
PRINCIPALS = [("t1", "1", "d1", "director", N, '["Self","Host"]'), ("t1", "1", "d2", "actor", "x", N)]
AKAS = [
    ("t1", "1", "First", "US", N, "alternative", "new,title", "1"),
    ("t1", "2", "Second", N, "en", N, N, "1"),
    ("t2", "1", "Other", "US", N, "a,b", N, "0"),
]
NAMES = [("d1", "Ann", "1950", "1940", "director,writer", "t1,t2,t1"), ("d2", "Bo", "x", N, N, N)]
DUMPS = {
    "title_basics": BASICS, "title_ratings": RATINGS, "title_crew": CREW, "title_episode": EPISODES,
    "title_principals": PRINCIPALS, "title_akas": AKAS, "name_basics": NAMES,
}


@pytest.fixture(scope="module")
def jobs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dumps")
    made = {}
    for name, records in DUMPS.items():
        lines = ["\t".join(RAW[name].names), *["\t".join(r) for r in records]]
        path = folder / f"{name}.tsv"
        path.write_text("\n".join(lines) + "\n")
        made[name] = C.curate_file(spark, name, str(path))
    return made


def checks(job):
    return {(r.check_name, r.subject): r.value for r in job.checks().collect()}


def test_quotes_and_empty_fields(jobs):
    main = {r.primaryTitle: r for r in jobs["title_basics"].main.collect()}
    assert main['"Quoted start'].genres == "Drama,Comedy" and main['"Quoted start'].isAdult is False
    assert None in main and main["Hole"].runtimeMinutes is None and main["Hole"].isAdult is None


def test_header_has_to_match(spark, tmp_path):
    path = tmp_path / "wrong.tsv"
    path.write_text("a\tb\tc\n1\t2\t3\n")
    with pytest.raises(Exception, match="(?i)header|names"):
        read_delimited(spark, str(path), RAW["title_ratings"]).collect()


def test_gzip(spark, tmp_path, rows):
    path = tmp_path / "r.tsv.gz"
    with gzip.open(path, "wt") as out:
        out.write("tconst\taverageRating\tnumVotes\n" + "".join(f"t{i}\t5.0\t{N}\n" for i in range(50)))
    df = read_delimited(spark, str(path), RAW["title_ratings"], spread=3)
    assert df.count() == 50 and df.rdd.getNumPartitions() == 3
    assert df.filter("numVotes is null").count() == 50


@pytest.mark.parametrize("name", list(DUMPS))
def test_schema_and_row_count(jobs, name):
    assert [(f.name, f.dataType) for f in jobs[name].main.schema] == [
        (f.name, f.dataType) for f in curated_schema(name)]
    assert checks(jobs[name])[("rows", "")] == len(DUMPS[name])


def test_basics_checks(jobs):
    found = checks(jobs["title_basics"])
    assert found[("violations", "future_start_year")] == 1 and found[("violations", "future_end_year")] == 1
    assert found[("violations", "negative_runtime")] == 1
    assert found[("duplicates", "tconst")] == 1
    assert (found[("min", "startYear")], found[("max", "startYear")]) == (1999, 2030)
    assert found[("nulls", "primaryTitle")] == 1 and found[("nulls", "isAdult")] == 1
    assert found[("child_rows", "genres")] == 8


def test_other_checks(jobs):
    assert checks(jobs["title_ratings"])[("violations", "rating_out_of_range")] == 1
    assert checks(jobs["title_ratings"])[("violations", "negative_votes")] == 1
    episodes = checks(jobs["title_episode"])
    assert episodes[("violations", "negative_season")] == 1 and episodes[("violations", "negative_episode")] == 1
    assert checks(jobs["title_principals"])[("duplicates", "tconst+ordering")] == 1
    assert checks(jobs["name_basics"])[("violations", "death_before_birth")] == 1


def test_principals_markup(jobs, rows):
    assert rows(jobs["title_principals"].main.select("nconst", "characters")) == [("d1", "Self,Host"), ("d2", None)]


def test_arrays(jobs, rows):
    crew = {r.tconst: r for r in jobs["title_crew"].with_arrays().collect()}
    assert (crew["t1"].directors_array, crew["t1"].writers_array) == (["d1", "d2"], ["w1", "w2", "w3"])
    assert (crew["t2"].directors_array, crew["t2"].writers_array) == ([], [])
    names = {r.nconst: r for r in jobs["name_basics"].with_arrays().collect()}
    assert names["d1"].known_titles_array == ["t1", "t2"] and names["d2"].professions_array == []
    akas = {(r.titleId, r.ordering): r for r in jobs["title_akas"].with_arrays().collect()}
    assert akas[("t1", 1)].attributes_array == ["new", "title"] and akas[("t1", 2)].types_array == []
    basics = jobs["title_basics"].with_arrays().filter("tconst = 't1' or primaryTitle = 'Again'").collect()
    assert {r.tconst for r in basics} == {"t1", "t3"}


def test_publish_writes_tables_and_counts(spark, jobs, tmp_path):
    seen = jobs["title_basics"].publish(f"{tmp_path}/basics")
    assert seen["rows|"] == 5 and seen["violations|negative_runtime"] == 1
    assert spark.read.parquet(f"{tmp_path}/basics").count() == 5
    assert spark.read.parquet(f"{tmp_path}/basics_genres").count() == 8


def test_views(jobs, rows):
    basics, ratings = jobs["title_basics"].main, jobs["title_ratings"].main
    view = content_performance(basics, ratings)
    assert view.count() == 5
    report = {r.table_name: r for r in data_quality_report({"title_basics": basics, "title_ratings": ratings}).collect()}
    assert (report["title_basics"].missing_titles, report["title_basics"].missing_genres) == (1, 1)
    assert (report["title_ratings"].row_count, report["title_ratings"].missing_genres) == (3, 0)


def test_two_originals_count_twice_unless_unique(jobs):
    akas = jobs["title_akas"].main
    assert originals(akas).count() == 2 and originals(akas, unique=True).count() == 1


def test_roles_multiply_works(spark):
    basics = spark.createDataFrame([(f"t{i}", "Drama") for i in range(3)], "tconst string, genres string")
    crew = spark.createDataFrame([(f"t{i}", "p1, p2", N) for i in range(3)], "tconst string, directors string, writers string")
    ratings = spark.createDataFrame([(f"t{i}", 8.0, 1000) for i in range(3)], "tconst string, averageRating double, numVotes int")
    akas = spark.createDataFrame([("t0", True)], "titleId string, isOriginalTitle boolean")
    roles = [("t0", "p1", "a", "x"), ("t0", "p1", "b", "y")]
    principals = spark.createDataFrame(roles, "tconst string, nconst string, category string, characters string")
    works = weighted_works(basics, crew, ratings, akas, principals, "directors")
    counts = {r.person_id: r.averageRating_count for r in talent_weighted(works).collect()}
    assert counts == {"p1": 4, "p2": 3}
    counts = {r.person_id: r.averageRating_count for r in talent_weighted(works, count_distinct_titles=True).collect()}
    assert counts == {"p1": 3, "p2": 3}
    assert weighted_works(basics, crew, ratings, akas, principals, "writers").count() == 0
    stats = person_stats(rated_works(ratings, basics, crew, akas, "directors"))
    names = spark.createDataFrame([("p2", "Bo")], "nconst string, primaryName string")
    assert [(r["rank"], r.person_id, r.name) for r in talent_by_rating(stats, names).orderBy("rank").collect()] == [
        (1, "p1", "Unknown"), (2, "p2", "Bo")]
    assert talent_by_consistency(stats).count() == 2


def test_all_keys_known():
    assert set(KEYS) == set(RAW) == set(DUMPS)

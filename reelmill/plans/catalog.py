"""The seven curation jobs: raw strings to typed tables, child tables and checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelmill.functions.columns import split_to_array
from reelmill.operators.lists import attach_list, explode_list
from reelmill.operators.profile import distribution, duplicate_keys
from reelmill.operators.shaping import cast_columns, strip_list_markup
from reelmill.schemas import KEYS, RAW, TYPED, curated_schema
from reelmill.session import materialize
from reelmill.sources.readers import read_delimited
from reelmill.sources.sinks import read_table, write_table_overwrite

# Child tables, ``{suffix: (list column, child column)}``.
CHILDREN = {
    "title_basics": {"genres": ("genres", "genre")},
    "title_crew": {"directors": ("directors", "director_id"), "writers": ("writers", "writer_id")},
    "title_akas": {"types": ("types", "type"), "attributes": ("attributes", "attribute")},
    "name_basics": {
        "professions": ("primaryProfession", "profession"),
        "known_titles": ("knownForTitles", "title_id"),
    },
}

# Columns whose minimum and maximum are reported, and whose distribution is.
RANGES = {
    "title_basics": ["startYear", "endYear"],
    "name_basics": ["birthYear", "deathYear"],
}
DISTRIBUTIONS = {
    "title_principals": {"category": None},
    "title_akas": {"region": 10, "language": 10},
}

# Fixed value: the year after which a start or end year counts as being in the future.
LATEST_YEAR = 2025


def rules_for(table: str, latest_year: int = LATEST_YEAR) -> dict[str, Column]:
    """What must not happen in a curated table."""
    col = F.col
    rules = {
        "title_basics": {
            "future_start_year": col("startYear") > latest_year,
            "future_end_year": col("endYear") > latest_year,
            "negative_runtime": col("runtimeMinutes") < 0,
        },
        "title_episode": {
            "negative_season": col("seasonNumber") < 0,
            "negative_episode": col("episodeNumber") < 0,
        },
        "title_ratings": {
            "rating_out_of_range": ~col("averageRating").between(0, 10),
            "negative_votes": col("numVotes") < 0,
        },
        "name_basics": {"death_before_birth": col("deathYear") < col("birthYear")},
    }
    return rules.get(table, {})


@dataclass
class Curated:
    """A curated table with its child tables, all lazy."""

    table: str
    main: DataFrame
    children: dict[str, DataFrame]
    latest_year: int = LATEST_YEAR

    def measures(self) -> dict[str, Column]:
        """Every check that is a plain aggregate, so that one pass computes them all."""
        found = {"rows|": F.count(F.lit(1))}
        found |= {f"nulls|{name}": F.count_if(F.col(name).isNull()) for name in self.main.columns}
        for name in RANGES.get(self.table, []):
            found[f"min|{name}"] = F.min(name).cast("long")
            found[f"max|{name}"] = F.max(name).cast("long")
        rules = rules_for(self.table, self.latest_year)
        found |= {f"violations|{name}": F.count_if(broken) for name, broken in rules.items()}
        for suffix, (col, _out) in CHILDREN.get(self.table, {}).items():
            listed = F.when(F.col(col) != "", F.size(split_to_array(F.col(col)))).otherwise(0)
            found[f"child_rows|{suffix}"] = F.coalesce(F.sum(listed), F.lit(0)).cast("long")
        return found

    def checks(self) -> DataFrame:
        """All checks as rows ``table_name, check_name, subject, value``. The dump is parsed once: plain checks are
        computed while the keys are stored, and duplicates come from the stored keys."""
        measures, seen, keys = self.measures(), Observation(), KEYS[self.table]
        stored = materialize(self.main.observe(seen, *[value.alias(name) for name, value in measures.items()]).select(*keys))
        duplicates = duplicate_keys(stored, keys).first()["duplicates"]
        found = {name: seen.get[name] for name in measures} | {"duplicates|" + "+".join(keys): duplicates}
        rows = [(self.table, *name.split("|"), value) for name, value in found.items()]
        return self.main.sparkSession.createDataFrame(rows, "table_name string, check_name string, subject string, value long")

    def distributions(self) -> dict[str, DataFrame]:
        wanted = DISTRIBUTIONS.get(self.table, {})
        return {col: distribution(self.main, col, n) for col, n in wanted.items()}

    def with_arrays(self) -> DataFrame:
        """The main table with one sorted array per child table."""
        keys = KEYS[self.table]
        lists = CHILDREN.get(self.table, {})
        arrays = {f"{suffix}_array": (self.children[suffix], keys, out) for suffix, (_, out) in lists.items()}
        empty = "null" if self.table == "title_basics" else "array"
        return attach_list(self.main, arrays, empty=empty, distinct=self.table == "name_basics")

    def publish(self, target: str) -> dict[str, int | None]:
        """Write the main table, its children and its distributions (``{target}_by_{column}``); gives all checks.

        Plain checks are computed during the write. Children, duplicates and distributions come from the table just
        written, so that the dump itself is parsed once.
        """
        measures = self.measures()
        seen = Observation()
        observed = self.main.observe(seen, *[value.alias(name) for name, value in measures.items()])
        write_table_overwrite(observed, target)
        stored = read_table(self.main.sparkSession, target)
        for suffix, child in _children(self.table, stored).items():
            write_table_overwrite(child, f"{target}_{suffix}")
        for col, n in DISTRIBUTIONS.get(self.table, {}).items():
            write_table_overwrite(distribution(stored, col, n), f"{target}_by_{col}")
        keys = KEYS[self.table]
        duplicates = {"duplicates|" + "+".join(keys): duplicate_keys(stored, keys).first()["duplicates"]}
        return {name: seen.get[name] for name in measures} | duplicates


def _children(table: str, main: DataFrame) -> dict[str, DataFrame]:
    return {
        suffix: explode_list(main, KEYS[table], col, out)
        for suffix, (col, out) in CHILDREN.get(table, {}).items()
    }


def curate(table: str, raw: DataFrame, latest_year: int = LATEST_YEAR) -> Curated:
    """Typed main table and exploded children of one raw dump."""
    main = cast_columns(raw.select(*RAW[table].names), TYPED[table])
    if table == "title_principals":
        main = strip_list_markup(main, "characters")
    if [(f.name, f.dataType) for f in main.schema] != [(f.name, f.dataType) for f in curated_schema(table)]:
        raise TypeError(f"{table} does not have its curated schema: {main.schema.simpleString()}")
    return Curated(table, main, _children(table, main), latest_year)


def curate_file(spark: SparkSession, table: str, path: str, latest_year: int = LATEST_YEAR) -> Curated:
    return curate(table, read_delimited(spark, path, RAW[table]), latest_year)


def curate_title_basics(raw: DataFrame, latest_year: int = LATEST_YEAR) -> Curated:
    return curate("title_basics", raw, latest_year)


def curate_title_ratings(raw: DataFrame) -> Curated:
    return curate("title_ratings", raw)


def curate_title_crew(raw: DataFrame) -> Curated:
    return curate("title_crew", raw)


def curate_title_episode(raw: DataFrame) -> Curated:
    return curate("title_episode", raw)


def curate_title_principals(raw: DataFrame) -> Curated:
    return curate("title_principals", raw)


def curate_title_akas(raw: DataFrame) -> Curated:
    return curate("title_akas", raw)


def curate_name_basics(raw: DataFrame) -> Curated:
    return curate("name_basics", raw)


"""Every operator and stage on odd rows and on an empty table: defined results, no crash, no lost row."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest
from reelmill.llm import decontaminate, jaccard_join, lang_id, lines, mixing, neighbours, periodic, pii, secrets, substring, token_store
from reelmill.llm.token_store import read_tokens, word_encoding, write_tokens


def _language(docs):
    return lang_id.identify(docs, lang_id.fit(docs, steps=20))


OPERATORS = {
    "pii": lambda docs: pii.find_personal_data(docs, pii.fit(docs)),
    "secrets": secrets.scan_secrets,
    "jaccard": jaccard_join.similar_documents,
    "mixing": mixing.mix_sources,
    "tokens": lambda docs: read_tokens(write_tokens(docs, word_encoding())),
    "language": _language,
    "passages": substring.drop_repeated_passages,
    "lines": lines.drop_repeated_lines,
    "periodic": periodic.find_runs,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_each_row_is_answered(odd_rows, name):
    ids = sorted((row.doc_id for row in odd_rows.collect()), key=str)
    assert sorted((row.doc_id for row in OPERATORS[name](odd_rows).collect()), key=str) == ids


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd_rows, name):
    assert OPERATORS[name](odd_rows.where("false")).collect() == []


def test_decontamination(odd_rows, documents, spark, prose):
    tests = spark.createDataFrame([(1, prose(30)), (2, None), (3, ""), (4, "one two"), (None, prose(20)), (1, prose(30))],
                                  "item_id long, text string")
    assert decontaminate.find_benchmark(odd_rows, tests).collect() == []
    assert decontaminate.find_benchmark(odd_rows.where("false"), tests).collect() == []
    assert decontaminate.find_benchmark(odd_rows, tests.where("false")).collect() == []


def test_neighbours(spark):
    ddl = "vec_id long, embedding array<float>, score int, part int"
    good = [(i, [float(i % 3), 1.0, 2.0], 1, 2) for i in range(1, 41)]
    bad = [(60, None, 1, 2), (80, [0.0, 0.0, 0.0], 1, 2), (100, [1.0, None, 2.0], 1, 2), (120, [1.0, float("nan"), 2.0], 1, 2),
           (140, [1.0, float("inf"), 2.0], 1, 2), (160, [1.0], 1, 2), (180, [], 1, 2), (None, [1.0, 1.0, 1.0], 1, 2)]
    found = neighbours.nearest_neighbours(spark.createDataFrame(good + bad + good[19:20], ddl), 20, 50).collect()
    assert sorted({row.query_id for row in found}) == [20, 40]
    assert all(sorted(r.vec_id for r in found if r.query_id == q) == [i for i in range(1, 41) if i != q] for q in (20, 40))
    assert neighbours.nearest_neighbours(spark.createDataFrame([], ddl), 20, 5).collect() == []
    assert neighbours.nearest_neighbours(spark.createDataFrame(bad, ddl), 20, 5).where("query_id <> 160").collect() == []


def test_stages(spark, odd_rows, tmp_path, prose):
    spark.createDataFrame([(1, prose(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd_rows, odd_rows.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, str(tmp_path))
            assert out.columns == corpus_pipeline.COLUMNS
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path)).collect()


def test_rows_without_ids_stay_alone(odd_rows):
    found = [r for r in jaccard_join.similar_documents(odd_rows).collect() if r.doc_id is None]
    assert [r.component_id for r in found] == [None, None] and {r.n_shingles > 0 for r in found} == {True, False}


def test_matrix_of_no_rows():
    assert neighbours.fit_router(np.zeros((0, 3)), 5).visits == 1

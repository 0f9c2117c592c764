"""The pipeline's stages against brute force, each on its own input."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from brute import components
from reelmill.llm import lang_id, mixing
from reelmill.llm.shared import frozen


@pytest.fixture
def folder(spark, prose, tmp_path):
    rng = random.Random(8)
    tests = [prose(25) for _ in range(5)]
    texts = [prose(rng.randint(20, 80)) for _ in range(60)]
    texts += [texts[0], texts[1], f"{texts[2]} end", f"{prose(10)} {tests[0]} {prose(10)}", f"{tests[1].title()}", "12 34", None]
    rows = [(i, t, "en" if i % 4 else "xx", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(tests)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = frozen(stage(spark, docs, folder), "test-stage")
        kept[name] = [r.doc_id for r in out.collect()]
        if name == "language":  # nothing but what has no letter
            assert sorted(kept[name]) == list(range(65))
        elif name == "near duplicates":
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert sorted(kept[name]) == sorted(k for k, (_, low) in components(texts).items() if k == low)
            assert {60, 61} & set(kept[name]) == set()
        elif name == "decontamination":
            assert sorted(kept[name]) == sorted(set(kept["near duplicates"]) - {63, 64})
        elif name == "mixing":
            taken = {r.doc_id: r.taken // r.size for r in mixing.mix_sources(docs).collect()}
            assert all(kept[name].count(k) == n for k, n in taken.items())
        else:
            assert kept[name] and sorted(kept[name]) == sorted(kept["mixing"])
            assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        docs = out


def test_run_is_the_stages_in_order(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "decontamination", "mixing", "token ids"]
    rows = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert lang_id.UNDECIDED == "und"


def test_language_stage_rejects_other_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*corpus_pipeline.COLUMNS)
    other = ["Быстрая коричневая лиса перепрыгивает через ленивую собаку и бежит дальше в лес " * 4, "Быстрая лиса", "1234 5678 " * 40, None]
    mixed = docs.unionByName(spark.createDataFrame([(10 ** 6 + k, t, None, "x", None) for k, t in enumerate(other)], docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, mixed, "").collect()}
    assert kept & {10 ** 6 + k for k in range(4)} == {10 ** 6 + 1}  # too short to tell
    known = {r.doc_id for r in docs.collect()}
    assert len(known - kept) <= 0.003 * len(known)


def test_language_stage_without_labels_keeps_all(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*corpus_pipeline.COLUMNS)
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.keep_known_languages(spark, blank, "").count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_language_stage_rejects_scripts_it_did_not_learn(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*corpus_pipeline.COLUMNS)
    other = ["Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί " * 4, "速い茶色の狐がのろまな犬を飛び越えて森の中へ " * 4,
             "Быстрая лиса бежит в лес " * 6, "השועל החום המהיר קופץ מעל הכלב העצלן " * 5]
    mixed = docs.unionByName(spark.createDataFrame([(10 ** 6 + k, t, None, "x", None) for k, t in enumerate(other)], docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, mixed, "").collect()}
    assert not kept & {10 ** 6 + k for k in range(len(other))}

"""From raw documents to token ids: language, near duplicates, benchmark passages, mixing, output.

Every stage takes and returns documents with the columns ``COLUMNS``; columns beyond these are left out by the first stage, and
a clash of names with an operator's own columns has no effect. Rows that share an id are documents of their own. An empty table
passes through all stages and gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.llm import decontaminate, jaccard_join, lang_id, mixing, token_store
from reelmill.llm.shared import frozen

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell.

    The network learns from four fifths of the labelled documents. A document goes if its text is missing or has no
    letter, or if it is long enough to tell and the network's score is lower than the scores of right answers on the labelled
    documents that were held out (``lang_id.least_score``): then it is in none of the learned languages, or in no language.
    Only characters that the network was trained on count for the score: of a strange script it has learned nothing, and
    what it says of one can be anything.
    Where there are no labels, nothing can be learned and every document with a letter stays. Rows without an id are
    judged but not learned from; equal rows are judged alike.
    """
    docs = docs.select(*COLUMNS)
    model = lang_id.fit(docs.where(lang_id.remainder(F.col("doc_id"), lang_id.FOLDS) != 0))
    found = lang_id.identify(docs, model, keep=("text", "lang", "source", "n_chars"), learned=True)
    if not model.languages:
        return found.where(lang_id.believable(0.0)).select(*COLUMNS)
    found = frozen(found, "languages")
    return found.where(lang_id.believable(lang_id.least_score(found))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similar shingles link. Rows that are equal in text are a group, with or without an id;
    documents without words, or without a text, are linked with nothing and stay."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Each row is judged by its own text, also if its id is missing or
    repeated; missing and empty texts hold nothing and stay, an empty benchmark keeps all."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = frozen(decontaminate.find_benchmark(docs, benchmark), "contaminated")
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, none more than three times. A missing source is a source of its own;
    documents without words weigh nothing and are not taken; rows equal in id and text are taken alike."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of all documents in shard files, read back: a row per document, repeated ones each time. Missing texts are
    empty documents, missing ids come first."""
    manifest = token_store.write_tokens(docs, token_store.word_encoding())
    return token_store.read_tokens(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token ids", write_token_ids),
]

ORACLE_SQL = None  # neither the language model nor the tokenizer can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is a table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = frozen(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs

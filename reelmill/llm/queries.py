"""The operators over whole tables, with the SQL that must give the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.llm import (decontaminate, divergence, jaccard_join, lang_id, lines, mixing, neighbours, periodic, pii, quality,
                          secrets, substring, token_store)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_decontaminate")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_benchmark(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.drop("text_id")


@_query("op2_personal_data")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = pii.find_personal_data(docs, pii.fit(docs))
    return found.select("doc_id", *[pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS],
                        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


@_query("op3_secrets")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


@_query("op4_jaccard_join")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@_query("op5_neighbours")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, folder, "embeddings"), every=20, k=20)


@_query("op6_mix_sources", r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as hash
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         ([5.0, 2.0, 1.0])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
  from docs group by source),
levels as (
  select *, 3 * source_size as cap,
         (sum(source_size) over () - coalesce(sum(3 * source_size) over (
            order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by 3 * source_size / weight, source nulls last
                             rows between current row and unbounded following) as level
  from sources),
plan as (
  select source, source_size, least(cap::double, first_value(case when level * weight <= cap then level end ignore nulls)
           over (order by cap / weight, source nulls last rows between unbounded preceding and unbounded following) * weight) as target
  from levels),
placed as (
  select d.*, p.source_size, p.target, case when p.source_size > 0 then floor(p.target / p.source_size) else 0 end as repeats,
         coalesce(sum(d.size) over (partition by d.source order by d.hash range between unbounded preceding and current row), 0)
         as upto, sum(d.size) over (partition by d.source, d.hash) as here
  from docs d join plan p on d.source is not distinct from p.source)
select doc_id, size, source_size, target,
       (size * (repeats + case when (target - repeats * source_size - (upto - here)) * 2 >= here then 1 else 0 end))::bigint as taken
from placed""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


@_query("op7_token_store")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_store.write_tokens(_table(spark, folder, "documents"), token_store.word_encoding())
    return token_store.read_tokens(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


@_query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    fold = lang_id.remainder(F.col("doc_id"), lang_id.FOLDS)
    found = lang_id.identify(docs, lang_id.fit(docs.where(fold != 0)))
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@_query("op9_substring_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring.drop_repeated_passages(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op10_line_dedup", r"""
with split as (
  select doc_id, text, string_split(text, chr(10)) as lines from documents),
counted as (
  select *, list_transform(lines, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) as words from split where text is not null),
windows as (
  select doc_id, lines, words, size, unnest(range(greatest(len(lines) - size + 1, 0))) as first
  from (select *, unnest([1, 2, 3]) as size from counted)),
runs as (
  select doc_id, first, size, 'part' as kind, lines[first + 1 : first + size] as run,
         list_sum(words[first + 1 : first + size]) as n from windows),
full_runs as (
  select *, min((doc_id, first)) over (partition by kind, run) as kept from (
    select doc_id, first, size, kind, run from runs where n >= 20 or (size = 3 and n > 0)
    union all select doc_id, 0, len(lines), 'whole', lines from counted where len(lines) < 3 and list_sum(words) > 0)),
gone as (
  select distinct doc_id, unnest(range(first, first + size)) as line from full_runs where (doc_id, first) <> kept),
each as (
  select s.doc_id, s.text, unnest(s.lines) as piece, unnest(range(len(s.lines))) as line from split s),
marked as (
  select e.*, g.line is not null as dropped from each e left join gone g on e.doc_id = g.doc_id and e.line = g.line)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_removed,
       sha256(coalesce(string_agg(piece, chr(10) order by line) filter (not dropped), '')) as kept_sha256
from marked group by doc_id""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.find_runs(_table(spark, folder, "documents")).drop("runs")


@_query("op12_source_divergence", r"""
with docs as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
per_doc as (
  select id, lang, source, term, count(*) as n from (select id, lang, source, unnest(terms) as term from docs) group by all),
kept as (
  select lang, term from per_doc group by all having count(*) >= 10),
counts as (
  select lang, source, term, sum(n)::hugeint as n from per_doc semi join kept using (lang, term) group by all),
vocabulary as (
  select lang, count(*) as v from kept group by all),
sizes as (
  select g.lang, g.source, coalesce(max(v), 0) as v, coalesce(sum(n), 0)::hugeint as total
  from (select distinct lang, source from docs) g left join vocabulary using (lang) left join counts using (lang, source)
  group by all),
dense as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (s.total + 2 * s.v) as p
  from sizes s join kept k using (lang) left join counts c using (lang, source, term)),
overall as (
  select d.lang, d.term, 1 + (1000000000::hugeint * (sum(d.n) + 2)) // (any_value(t.total) + 2 * any_value(t.v)) as q
  from dense d join (select lang, sum(total) as total, max(v) as v from sizes group by lang) t using (lang) group by all),
sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from dense a join dense b using (lang, term) where a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(s.value, 0)::bigint as value
  from sizes a join sizes b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (
  select lang, source, term as item, ((p - q) * (p - q) // (p + q))::bigint as value
  from dense join overall using (lang, term) where n > 0 and p > q)
select lang, source, 'pair' as part, item, value,
       row_number() over (partition by lang, source order by value desc, item)::int as rank from pairs
union all
select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item)::int as place
from terms qualify place <= 10""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, folder, "documents"))


@_query("op13_quality")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = quality.score(docs, quality.fit(docs, quality.learnable(_table(spark, folder, "labels"))))
    held_out = F.coalesce(lang_id.remainder(F.col("doc_id"), quality.FOLDS) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from reelmill.plans.audit import audit_files, ingestion_audit
from reelmill.session import fresh_path, shared_folder
from reelmill.sources import sinks
from reelmill.sources.fingerprints import source_fingerprint, table_fingerprint


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder and (named is None or folder == named)
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_row_limit(spark, tmp_path):
    sinks.write_row_limited(spark.range(1000).coalesce(1), f"{tmp_path}/out", 300)
    sizes = spark.read.parquet(f"{tmp_path}/out").groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in sizes) == [100, 300, 300, 300]


def test_overwrite_table(spark):
    sinks.write_table_overwrite(spark.range(3), "overwrite_me")
    sinks.write_table_overwrite(spark.range(5), "overwrite_me")
    assert sinks.read_table(spark, "overwrite_me").count() == 5
    spark.sql("DROP TABLE overwrite_me")


def test_event_table_is_created_once_and_pruned(spark, tmp_path):
    path = f"{tmp_path}/events"
    events = spark.range(100).selectExpr(
        "cast(id as string) user_id", "'c' content_id", "'start' event_type",
        "timestamp_seconds(1704067200 + id * 3600) `timestamp`")
    sinks.create_event_table(spark, path, events.schema)
    assert sinks.read_event_table(spark, path, events.schema).count() == 0
    sinks.write_event_table(events, path)
    sinks.create_event_table(spark, path, events.schema)
    day = sinks.read_event_table(spark, path, events.schema).filter("event_date = date'2024-01-02'")
    assert day.count() == 24
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().toString()


def test_folders_and_files_of_one_name(spark, tmp_path):
    for folder, text in (("one", "1\n2\n"), ("two", "1\n"), ("empty", "")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.tsv").write_text(text)
    (tmp_path / "two" / "b.tsv").write_text("2\n")
    files = {r.dataset_name: r for r in source_fingerprint(spark, f"{tmp_path}/*/*.tsv").collect()}
    assert sorted(files) == [f"{tmp_path}/{name}" for name in ("one/a.tsv", "two/a.tsv", "two/b.tsv")]
    folders = {r.dataset_name.rpartition("/")[2]: r for r in source_fingerprint(spark, f"{tmp_path}/*/*.tsv", "folder").collect()}
    assert folders["one"].md5_hash == folders["two"].md5_hash != files[f"{tmp_path}/two/a.tsv"].md5_hash
    assert {k: r.file_size_bytes for k, r in folders.items()} == {"one": 4, "two": 4}
    lanes = [sum(int(hashlib.md5(x).hexdigest()[8 * i:8 * i + 8], 16) for x in (b"1", b"2")) for i in range(4)]
    assert folders["one"].md5_hash == hashlib.md5(":".join(map(str, [2, *lanes])).encode()).hexdigest()


def test_the_order_of_lines_plays_no_part(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("1\n2\n3\n")
    (tmp_path / "b.tsv").write_text("3\n1\n2\n")
    (tmp_path / "c.tsv").write_text("3\n1\n4\n")
    found = {r.dataset_name.rpartition("/")[2]: r for r in source_fingerprint(spark, f"{tmp_path}/*.tsv").collect()}
    assert found["a.tsv"].md5_hash == found["b.tsv"].md5_hash != found["c.tsv"].md5_hash
    assert found["a.tsv"].file_size_bytes == 6


def test_table_hash_ignores_order_and_sees_null(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    c = spark.createDataFrame([(2, ""), (1, "x")], "k int, v string")
    hashes = [table_fingerprint(df, ["k", "v"]).first().md5_hash for df in (a, b, c)]
    assert hashes[0] == hashes[1] != hashes[2]


def test_audit_first_same_changed_missing(spark, tmp_path):
    log = f"{tmp_path}/log"

    def run(**hashes):
        current = spark.createDataFrame([(k, 1, v) for k, v in hashes.items()],
                                        "dataset_name string, file_size_bytes long, md5_hash string")
        expected = spark.createDataFrame([("a",), ("b",)], "dataset_name string")
        return {r.dataset_name: (r.present, r.has_changed) for r in ingestion_audit(current, log, expected).collect()}

    assert run(a="1", b="1") == {"a": (True, True), "b": (True, True)}
    assert run(a="1", b="2") == {"a": (True, False), "b": (True, True)}
    assert run(a="1") == {"a": (True, False), "b": (False, False)}
    assert run(a="3", b="2") == {"a": (True, True), "b": (True, False)}
    logged = sinks.read_ingestion_log(spark, log)
    assert logged.count() == 7


def test_audit_of_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.tsv").write_text("1\n")
    (folder / "b.tsv").write_text("2\n")

    def run():
        found = audit_files(spark, f"{folder}/*.tsv", f"{tmp_path}/log", ["a.tsv", "b.tsv", "c.tsv"])
        return {r.dataset_name: (r.present, r.has_changed) for r in found.collect()}

    assert run() == {"a.tsv": (True, True), "b.tsv": (True, True), "c.tsv": (False, False)}
    (folder / "b.tsv").write_text("3\n")
    assert run() == {"a.tsv": (True, False), "b.tsv": (True, True), "c.tsv": (False, False)}


def test_counted_write(spark, tmp_path):
    seen = sinks.write_counted(spark.range(10), lambda df: df.filter("id > 3"), f"{tmp_path}/out")
    assert seen == {"rows_before": 10, "rows_after": 6}

from __future__ import annotations

import json

import pytest

from reelmill.sources import sinks
from reelmill.streaming import events as E

FULL = {
    "event_id": "e1", "user_id": "u1", "content_id": "tt1", "event_type": "rate", "timestamp": "2023-03-05T07:08:09Z",
    "session_id": "s", "duration": 431, "position": 77, "device": {"type": "tv", "os": "tvOS"},
    "location": {"country": "IN"}, "quality": {"resolution": "4K", "bitrate": 9100}, "rating": 3,
    "extra_attributes": {"muted": True}, "unknown": 1,
}
MINIMAL = {"event_id": "e2", "user_id": "u1", "content_id": "tt1", "event_type": "start", "timestamp": "2023-03-06T01:02:03.456789"}
BAD = {
    "malformed": ['{"event_id": "x"', "[1, 2]", '"text"', "", '[{"event_id": "e9"}]', json.dumps({**FULL, "rating": "five"})],
    "no event_id": [json.dumps({k: v for k, v in FULL.items() if k != "event_id"})],
}
NO_USER = {**MINIMAL, "event_id": "e3", "user_id": None}


def messages(spark, *texts):
    data = [(t if isinstance(t, (bytes, bytearray)) else t.encode(),) for t in texts]
    return spark.createDataFrame([(bytearray(b),) for (b,) in data], "value binary")


def test_good_messages(spark):
    good, dead = E.parse_events(messages(spark, json.dumps(FULL), json.dumps(MINIMAL)))
    rows = {r.event_id: r for r in good.collect()}
    assert dead.count() == 0 and set(rows) == {"e1", "e2"}
    assert rows["e1"].device.type == "tv" and rows["e1"].device.model is None and rows["e1"].quality.bitrate == 9100
    assert json.loads(rows["e1"].extra_attributes) == {"muted": True}
    assert str(rows["e2"].timestamp) == "2023-03-06 01:02:03.456789" and rows["e2"].rating is None


def test_time_with_and_without_zone(spark):
    good, _ = E.parse_events(messages(spark, json.dumps(FULL)))
    assert good.selectExpr("unix_timestamp(timestamp)").first()[0] == 1678000089


@pytest.mark.parametrize("reason", list(BAD))
def test_dead_letters(spark, reason):
    good, dead = E.parse_events(messages(spark, *BAD[reason]))
    assert good.count() == 0
    assert [r.reason for r in dead.collect()] == [reason] * len(BAD[reason])


def test_bytes_that_are_no_text(spark):
    _, dead = E.parse_events(messages(spark, b'{"event_id": "\xff\xfe"}'))
    assert [r.reason for r in dead.collect()] == ["not UTF-8"]


def test_required(spark):
    parsed, _ = E.parse_events(messages(spark, json.dumps(NO_USER), json.dumps(MINIMAL)))
    good, dead = E.enforce_required(parsed)
    assert [r.event_id for r in good.collect()] == ["e2"]
    assert [r.reason for r in dead.collect()] == ["missing user_id"]


def test_flat_names(spark):
    good, _ = E.parse_events(messages(spark, json.dumps(FULL)))
    flat = E.flatten_event(good)
    assert {"device_type", "device_model", "location_city", "quality_bitrate", "rating"} <= set(flat.columns)


def test_ingest_restart_and_late_copy(spark, tmp_path):
    source, paths = tmp_path / "in", E.IngestPaths(f"{tmp_path}/out")
    source.mkdir()

    def run():
        stream = E.read_event_stream(spark, "text", path=str(source))
        E.run_to_end(E.event_ingest(stream, paths, dedupe_days=7))
        stored = sorted((r.event_id, str(r.event_date)) for r in spark.read.parquet(paths.events).collect())
        return stored, sorted(r.reason for r in spark.read.parquet(paths.dead).collect())

    (source / "1.txt").write_text("\n".join([json.dumps(FULL), json.dumps(FULL), '{"bad', json.dumps(NO_USER)]))
    first = run()
    assert first == ([("e1", "2023-03-05")], ["malformed", "missing user_id"])
    assert run() == first
    (source / "2.txt").write_text("\n".join([json.dumps(FULL), json.dumps(MINIMAL)]))
    assert run() == ([("e1", "2023-03-05"), ("e2", "2023-03-06")], first[1])


def _feed(spark, tmp_path, paths, name, *events):
    source = tmp_path / "in"
    source.mkdir(exist_ok=True)
    (source / name).write_text("\n".join(json.dumps(e) for e in events))
    stream = E.read_event_stream(spark, "text", path=str(source))
    E.run_to_end(E.event_ingest(stream, paths, dedupe_days=7))
    return sorted((r.event_id, str(r.event_date), r.batch_id) for r in spark.read.parquet(paths.events).collect())


def test_late_events_are_stored_and_their_copies_found(spark, tmp_path):
    paths = E.IngestPaths(f"{tmp_path}/out")
    old = {**MINIMAL, "event_id": "old", "timestamp": "2019-01-02T03:04:05Z"}
    first = _feed(spark, tmp_path, paths, "1.txt", FULL, MINIMAL)
    assert first == [("e1", "2023-03-05", 0), ("e2", "2023-03-06", 0)]
    # years behind everything seen so far, and a copy of it within the batch
    second = _feed(spark, tmp_path, paths, "2.txt", old, old)
    assert second == [*first, ("old", "2019-01-02", 1)]
    # a later batch knows both the late event and, a day off, one of the first batch
    shifted = {**FULL, "timestamp": "2023-03-07T00:00:00Z"}
    assert _feed(spark, tmp_path, paths, "3.txt", old, shifted) == second
    # beyond the days that are looked up, an id is new
    assert len(_feed(spark, tmp_path, paths, "4.txt", {**FULL, "timestamp": "2023-03-20T00:00:00Z"})) == 4


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    path = f"{tmp_path}/table"
    good, _ = E.parse_events(messages(spark, json.dumps(FULL), json.dumps(MINIMAL)))
    for _ in range(2):
        E._store(good, path, 4, 2, "timestamp", ["user_id"], "event_id", 7)
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["e1", "e2"]
    E._store(good, path, 5, 2, "timestamp", ["user_id"], "event_id", 7)
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["e1", "e2"]


def test_days_are_compacted(spark, tmp_path):
    paths = E.IngestPaths(f"{tmp_path}/out")
    for k in range(4):
        some = [{**MINIMAL, "event_id": f"{k}-{i}", "user_id": f"u{i % 3}", "timestamp": f"2023-03-{5 + i % 2:02}T01:00:0{i}Z"} for i in range(6)]
        before = _feed(spark, tmp_path, paths, f"{k}.txt", *some)
    assert len(before) == 24
    assert sinks.compact_days(spark, paths.events) == 2
    table = spark.read.parquet(paths.events)
    assert sorted(r.event_id for r in table.collect()) == sorted(e for e, _, _ in before)
    # the last batch stays under its number, the others are one, in order
    assert {(str(r.event_date), r.batch_id) for r in table.collect()} == {(d, b) for d in ("2023-03-05", "2023-03-06") for b in (-1, 3)}
    joined = table.where("batch_id = -1")
    assert len(joined.inputFiles()) <= 4
    for file in {f for f in joined.inputFiles() if "batch_id=-1" in f}:
        rows = [(r.user_id, r.content_id, r.event_type, r.timestamp) for r in spark.read.parquet(file).collect()]
        assert rows == sorted(rows)
    assert sinks.compact_days(spark, paths.events) == 0
    again = [{**MINIMAL, "event_id": "0-1", "user_id": "u1", "timestamp": "2023-03-06T01:00:01Z"}]
    assert len(_feed(spark, tmp_path, paths, "again.txt", *again)) == 24


def test_an_interrupted_compaction_is_completed(spark, tmp_path, monkeypatch):
    paths = E.IngestPaths(f"{tmp_path}/out")
    for k in range(3):
        before = _feed(spark, tmp_path, paths, f"{k}.txt", {**MINIMAL, "event_id": str(k)}, {**FULL, "event_id": f"f{k}"})
    with monkeypatch.context() as m:
        calls = []

        def stop_at_plan(session, path):
            calls.append(path)
            if len(calls) == 2:
                raise RuntimeError("lost")

        m.setattr(sinks, "_exchange", stop_at_plan)
        with pytest.raises(RuntimeError):
            sinks.compact_days(spark, paths.events)
    assert len(spark.read.parquet(paths.events).collect()) == len(before)
    assert sinks.compact_days(spark, paths.events) == 0  # completes the stored plan
    rows = spark.read.parquet(paths.events).collect()
    assert sorted(r.event_id for r in rows) == sorted(e for e, _, _ in before) and {r.batch_id for r in rows} == {-1, 2}


def test_static_frames_give_the_same_as_streams(spark):
    parsed, _ = E.parse_events(messages(spark, json.dumps(FULL), json.dumps(FULL), json.dumps(MINIMAL)))
    assert E.dedupe_events(parsed, "event_id", "timestamp").count() == 2

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from touchline.operators import events
from touchline.plans import registry
from touchline.schemas import SHOT, SHOT_IGNORED
from touchline.sources import commits, landing
from touchline.sources.paths import create_new, read_small
from touchline.streaming import shots as stream


def bytes_read(spark):
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")


def shot(**given):
    base = dict(
        X=0.5, Y=0.25, a_goals=1.0, a_team="A", date="2015-01-01 20:00:00", h_goals=2.0, h_team="H",
        id=1.0, league="epl", match_id=10.0, result="Goal", season="2014-2015",
    )
    return base | given


def frame(spark, *given):
    return spark.createDataFrame([tuple(shot(**g)[n] for n in SHOT.names) for g in given], SHOT)


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_bytes_are_parsed_and_other_fields_ignored(spark):
    text = json.dumps(shot() | {name: "x" for name in SHOT_IGNORED})
    df = messages(spark, text).select(F.col("value").cast("binary"))
    got = events.valid_events(events.parse_events(df))
    assert got.columns == SHOT.names
    assert got.first().asDict() == shot()


@pytest.mark.parametrize("text", ["not json", None, '{"id":"12"}', "[]", "{}", "5"])
def test_useless_messages_are_set_aside(spark, text):
    parsed = events.parse_events(messages(spark, text))
    assert events.valid_events(parsed).count() == 0
    assert rows(events.bad_events(parsed)) == [(text,)]


def test_partly_bad_message_keeps_its_good_fields(spark):
    got = events.valid_events(events.parse_events(messages(spark, '{"X":"abc","id":3,"result":"Goal"}')))
    assert got.select("X", "id", "result").first() == (None, 3.0, "Goal")


def test_nan_is_null(spark):
    text = '{"X":NaN,"id":3,"result":NaN,"h_goals":NaN}'
    got = events.valid_events(events.parse_events(messages(spark, text)))
    assert got.select("X", "result", "h_goals").first() == (None, None, None)


def test_coordinates(spark):
    assert events.scale_coords(frame(spark, {})).select("X", "Y").first() == (50.0, 25.0)


def test_labels(spark):
    got = events.labelled(frame(spark, {}, {"h_team": None})).select("match_identifier")
    assert rows(got) == [("H vs A (2015-01-01)",), (None,)]


def test_colours(spark):
    results = ["MissedShots", "BlockedShot", "Goal", "SavedShot", "ShotOnPost", None]
    got = events.shot_map(frame(spark, *({"result": r, "id": float(i)} for i, r in enumerate(results))))
    assert [r.colour for r in got.orderBy("id").collect()] == ["red", "blue", "orange", "yellow", "gray", "gray"]


def test_outcome(spark):
    df = frame(spark, {"id": 2.0, "h_goals": 9.0}, {"id": 1.0}, {"id": 3.0, "match_id": 11.0, "a_goals": None})
    got = events.match_outcome(df).select("match_id", "title", "outcome")
    assert rows(got) == [(10.0, "H vs A", "2 - 1"), (11.0, "H vs A", None)]
    none = events.match_outcome(events.select_match(df, 99.0, "2014-2015", "epl"))
    assert none.count() == 0


def test_match_list_takes_the_first_event(spark):
    df = frame(
        spark,
        {"id": 5.0, "h_team": "late"},
        {"id": 4.0},
        {"match_id": None, "id": 6.0},
        {"match_id": None, "id": 7.0},
    )
    assert rows(events.match_list(df)) == [("H vs A (2015-01-01)", 10.0), ("H vs A (2015-01-01)", None)]


def test_first_selection(spark):
    df = frame(spark, {"id": 5.0, "match_id": 2.0}, {"id": 4.0, "match_id": 3.0}, {"id": 6.0, "match_id": 3.0})
    assert rows(events.first_selection(df)) == [("epl", "2014-2015", 3.0)]
    assert rows(events.select_first_match(df).select("id")) == [(4.0,), (6.0,)]


def test_published_messages_keep_nulls(spark):
    text = landing.as_messages(frame(spark, {"a_team": None})).first().value
    assert json.loads(text)["a_team"] is None


def land(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def test_stream_equals_batch_and_restarts_cleanly(spark, tmp_path):
    landed, table, progress = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "p")
    for i in range(4):
        land(landed, f"{i}.json", shot(id=float(i)), "not json", shot(id=100.0 + i, league="la_liga"))

    def run():
        stream.run_shot_stream(stream.file_messages(spark, str(landed), 2), table, progress)

    run()
    batch = events.valid_events(events.shot_rows(spark.read.text(str(landed))))
    assert rows(stream.scan_events(spark, table)) == rows(batch)
    assert stream.scan_bad_events(spark, table).count() == 4
    assert {r.batch_id for r in stream.scan_bad_events(spark, table).collect()} == {0, 1}

    run()
    assert stream.scan_events(spark, table).count() == 8
    land(landed, "later.json", shot(id=50.0))
    run()
    assert stream.scan_events(spark, table).count() == 9


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    df = events.shot_rows(landing.as_messages(frame(spark, {"id": 1.0}, {"id": 2.0})))
    table = str(tmp_path / "t")
    for _ in range(2):
        stream.write_batch(df, 0, table, "s")
    stream.write_batch(df, 1, table, "s")
    assert stream.scan_events(spark, table).count() == 4


def test_new_checkpoint_does_not_overwrite(spark, tmp_path):
    landed, table = tmp_path / "in", str(tmp_path / "t")
    land(landed, "0.json", shot())
    for progress in ("p1", "p2"):
        stream.run_shot_stream(stream.file_messages(spark, str(landed)), table, str(tmp_path / progress))
    assert stream.scan_events(spark, table).count() == 2


def test_match_filter_reaches_the_scan(spark, tmp_path):
    table = str(tmp_path / "t")
    stream.write_batch(events.shot_rows(landing.as_messages(frame(spark, {}))), 0, table, "s")
    text = plan(events.shot_map(events.select_match(stream.scan_events(spark, table), 10.0, "2014-2015", "epl")))
    assert "PartitionFilters: [isnotnull(season" in text
    assert "EqualTo(match_id,10.0)" in text
    assert "h_team" not in text.split("ReadSchema")[1].split("\n")[0]


def test_running_stream_picks_up_new_files(spark, tmp_path):
    landed, table = tmp_path / "in", str(tmp_path / "t")
    land(landed, "0.json", shot(id=1.0))
    query = stream.start_shot_stream(
        stream.file_messages(spark, str(landed)), table, str(tmp_path / "p"), interval="1 second"
    )
    try:
        query.processAllAvailable()
        land(landed, "1.json", shot(id=2.0))
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.id for r in stream.scan_events(spark, table).collect()) == [1.0, 2.0]


def test_stream_into_memory(spark, tmp_path):
    landed = tmp_path / "in"
    land(landed, "0.json", shot(), "not json")
    query = (
        events.shot_rows(stream.file_messages(spark, str(landed)))
        .writeStream.format("memory")
        .queryName("shots_in_memory")
        .outputMode("append")
        .start()
    )
    try:
        query.processAllAvailable()
        assert spark.table("shots_in_memory").count() == 2
    finally:
        query.stop()


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        stream.kafka_messages(spark, "localhost:9092")


def batches(spark, table, *ids, first=0):
    for n, i in enumerate(ids, first):
        stream.write_batch(events.shot_rows(landing.as_messages(frame(spark, {"id": float(i)}))), n, table, "s")


def test_merged_batches_read_like_before(spark, tmp_path):
    table = str(tmp_path / "t")
    batches(spark, table, 1, 2, 3)
    assert stream.compact(spark, table) == 3 and stream.compact(spark, table) == 0
    batches(spark, table, 4, 5, first=3)
    assert sorted(r.id for r in stream.scan_events(spark, table).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert stream.compact(spark, table) == 2
    assert len(stream.scan_events(spark, table).inputFiles()) == 2
    stream.compact(spark, table, retention=0)
    left = [p for p in (tmp_path / "t" / "events").rglob("*.parquet")]
    assert len(left) == len(list((tmp_path / "t" / "events").glob("part=*"))) == 2
    assert sorted(r.id for r in stream.scan_events(spark, table).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_a_merged_batch_is_not_written_again(spark, tmp_path):
    table = str(tmp_path / "t")
    batches(spark, table, 1, 2)
    stream.compact(spark, table)
    batches(spark, table, 1, 2)
    assert stream.scan_events(spark, table).count() == 2


def test_a_merge_that_died_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    batches(spark, table, 1, 2)
    frame(spark, {"id": 9.0}).write.parquet(f"{table}/events/part=died/season=x/league=y")
    assert sorted(r.id for r in stream.scan_events(spark, table).collect()) == [1.0, 2.0]
    assert stream.compact(spark, table) == 2
    assert (tmp_path / "t" / "events" / "part=died").exists()
    stream.compact(spark, table, retention=0)
    assert not (tmp_path / "t" / "events" / "part=died").exists()
    assert sorted(r.id for r in stream.scan_events(spark, table).collect()) == [1.0, 2.0]


def test_replay_overwrites_whatever_the_session_says(spark, tmp_path):
    table = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for league in ("old", "new"):
            df = events.shot_rows(landing.as_messages(frame(spark, {"league": league})))
            stream.write_batch(df, 0, table, "s")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.league for r in stream.scan_events(spark, table).collect()] == ["new"]


def test_a_timeout_is_told(spark, tmp_path):
    landed = tmp_path / "in"
    for n in range(30):
        land(landed, f"{n}.json", shot(id=float(n)))
    with pytest.raises(TimeoutError):
        stream.run_shot_stream(
            stream.file_messages(spark, str(landed), 1), str(tmp_path / "t"), str(tmp_path / "p"), timeout=1
        )
    assert not [q for q in spark.streams.active if q.isActive]


def ids(df):
    return sorted(r.id for r in df.collect())


def some_bad(spark, *texts):
    return events.shot_rows(messages(spark, *texts, json.dumps(shot(id=float(len(texts[0]))))))


def test_a_frame_that_was_planned_before_a_merge_still_answers(spark, tmp_path):
    table = str(tmp_path / "t")
    batches(spark, table, 1, 2)
    planned = stream.scan_events(spark, table)
    stream.compact(spark, table)
    batches(spark, table, 3, first=2)
    stream.compact(spark, table)
    assert ids(planned) == [1.0, 2.0] and ids(stream.scan_events(spark, table)) == [1.0, 2.0, 3.0]
    assert stream.versions(spark, table) == [1, 2, 3, 4, 5]
    assert ids(stream.scan_events(spark, table, version=1)) == [1.0]
    with pytest.raises(ValueError):
        stream.scan_events(spark, table, version=9)


def test_a_replay_after_a_merge_loses_no_unusable_message(spark, tmp_path):
    """A batch dies between its two writes, a merge runs, the batch is replayed."""
    table = str(tmp_path / "t")
    stream.write_batch(some_bad(spark, "bad one"), 0, table, "s")
    frame(spark, {"id": 5.0}).write.partitionBy("season", "league").parquet(f"{table}/events/part=half")
    assert stream.compact(spark, table) == 1
    for _ in range(2):
        stream.write_batch(some_bad(spark, "bad two!"), 1, table, "s")
    assert ids(stream.scan_events(spark, table)) == [7.0, 8.0]
    stream.compact(spark, table)
    stream.write_batch(some_bad(spark, "bad two!"), 1, table, "s")
    bad = stream.scan_bad_events(spark, table).collect()
    assert sorted((r.raw_message, r.stream_id, r.batch_id) for r in bad) == [("bad one", "s", 0), ("bad two!", "s", 1)]


def test_batches_without_events_or_without_bad_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    stream.write_batch(events.shot_rows(messages(spark, "bad")), 0, table, "s")
    assert stream.compact(spark, table) == 1 and stream.scan_events(spark, table).count() == 0
    batches(spark, table, 4, first=1)
    assert ids(stream.scan_events(spark, table)) == [4.0] and stream.scan_bad_events(spark, table).count() == 1
    empty = str(tmp_path / "none")
    assert stream.compact(spark, empty) == 0 and stream.scan_bad_events(spark, empty).count() == 0


def test_a_batch_that_is_replayed_during_a_merge_is_not_lost(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    batches(spark, table, 1, 2)
    write = stream._write_part

    def slow(*args):
        part = write(*args)
        monkeypatch.setattr(stream, "_write_part", write)
        batches(spark, table, 2.5, 3, first=1)  # batch 1 again with other content, and a new one
        return part

    monkeypatch.setattr(stream, "_write_part", slow)
    assert stream.compact(spark, table) == 0
    assert ids(stream.scan_events(spark, table)) == [1.0, 2.5, 3.0]
    assert stream.compact(spark, table) == 3
    assert ids(stream.scan_events(spark, table)) == [1.0, 2.5, 3.0]


def test_streams_and_merges_commit_beside_each_other(spark, tmp_path):
    table = str(tmp_path / "t")

    def load(name):
        for n in range(3):
            df = events.shot_rows(landing.as_messages(frame(spark, {"id": float(n), "a_team": name})))
            stream.write_batch(df, n, table, name)
            if name == "a":
                stream.compact(spark, table)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(load, "abc"))
    stream.compact(spark, table)
    got = stream.scan_events(spark, table).select("a_team", "id").collect()
    assert sorted(map(tuple, got)) == [(name, float(n)) for name in "abc" for n in range(3)]


def test_old_commits_go_and_one_of_many_creates_a_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_COMMITS", 3)
    log = str(tmp_path / "log")
    for n in range(6):
        commits.commit(spark, log, lambda s, n=n: replace(s, marks={"s": n}))
    assert commits.versions(spark, log) == [4, 5, 6] and commits.state(spark, log).marks == {"s": 5}
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: create_new(spark, str(tmp_path / "x" / "claim"), str(n)), range(8)))
    assert sum(won) == 1 and read_small(spark, str(tmp_path / "x" / "claim")) == str(won.index(True))
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["claim"]


def test_row_groups_without_a_match_are_skipped_by_their_bloom_filter(spark, tmp_path):
    table = str(tmp_path / "t")
    for n in range(4):  # each batch covers the whole range of matches, and has its own
        made = spark.range(5_000).select(
            *(F.lit(v).cast(SHOT[k].dataType).alias(k) for k, v in shot().items() if k not in ("id", "match_id")),
            F.col("id").cast("double").alias("id"),
            (F.col("id") * 4 + n).cast("double").alias("match_id"),
        )
        stream.write_batch(events.shot_rows(landing.as_messages(made.select(*SHOT.names))), n, table, "s")
    df = stream.scan_events(spark, table).where("match_id = 402")

    before = bytes_read(spark)
    assert [r.id for r in df.select("id").collect()] == [100.0]
    with_filter = bytes_read(spark) - before
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    try:
        before = bytes_read(spark)
        assert [r.id for r in stream.scan_events(spark, table).where("match_id = 402").select("id").collect()] == [100.0]
        without = bytes_read(spark) - before
    finally:
        spark.conf.unset("parquet.filter.bloom.enabled")
    files = list((tmp_path / "t" / "events").rglob("*.parquet"))
    assert len(files) == 4 and with_filter > 0 and without > 0
    place = [n for n in SHOT.names if n not in ("season", "league")].index("match_id")
    found = [pq.ParquetFile(f).metadata.row_group(0).column(place) for f in files]
    assert all(c.statistics.min <= 402 <= c.statistics.max for c in found)
    assert with_filter < without


def test_repeated_shots_are_stored_once_and_forgotten_in_time(spark, tmp_path):
    landed, table, progress = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "p")
    day = lambda n: f"2015-01-{n:02d} 20:00:00"
    land(landed, "0.json", shot(id=1.0, date=day(1)), shot(id=1.0, date=day(1)), "not json", "not json")
    land(landed, "1.json", shot(id=1.0, date=day(2)), shot(id=2.0, date=day(2)), shot(id=3.0, date=None), shot(id=3.0, date="?"))
    land(landed, "2.json", *(shot(id=float(n), date=day(20)) for n in range(10, 14)))
    land(landed, "3.json", shot(id=10.0, date=day(21)), shot(id=5.0, date=day(19)))
    land(landed, "4.json", shot(id=4.0, date=day(1)), shot(id=11.0, date=day(21)))

    def run():
        for n, file in enumerate(sorted(landed.glob("*.json"))):  # the order in which they were landed
            os.utime(file, (1_700_000_000 + 60 * n,) * 2)
        source = stream.file_messages(spark, str(landed), 1)
        query = stream.start_shot_stream(source, table, progress, available_now=True, once_within="3 days")
        query.awaitTermination()
        return query.recentProgress

    held = [p["stateOperators"][0]["numRowsTotal"] for p in run() if p["stateOperators"]]
    want = [1.0, 2.0, 3.0, 3.0, 5.0, 10.0, 11.0, 12.0, 13.0]  # 4 is late; 1, 10 and 11 came before
    assert ids(stream.scan_events(spark, table)) == want
    assert stream.scan_bad_events(spark, table).count() == 2
    assert max(held) <= 6 and held[-1] <= 5  # 1 and 2 are forgotten
    land(landed, "5.json", shot(id=13.0, date=day(20)), shot(id=14.0, date=day(20)))
    run()
    assert ids(stream.scan_events(spark, table)) == [*want, 14.0]


def test_many_messages_are_landed_by_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "LANDED", 10)
    messages, landed = spark.range(100).selectExpr("cast(id as string) as value"), tmp_path / "in"
    assert registry._land(messages, str(landed), 2) == 5
    assert len(list(landed.glob("*.txt"))) == 10
    assert registry._land(messages.limit(3), str(landed), 2) == 1 and len(list(landed.glob("*.txt"))) == 12
    assert sorted(int(r.value) for r in spark.read.text(str(landed)).collect()) == sorted([*range(100), *range(3)])
    assert registry._land(messages.limit(0), str(tmp_path / "none"), 2) == 1

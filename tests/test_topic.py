from __future__ import annotations

import json

from pyspark.sql import functions as F

from test_shots import frame, ids, shot
from touchline.sources import landing
from touchline.streaming import shots as stream
from touchline.streaming import topic as topics
from touchline.streaming.topic import publish_to_topic, publish_with_report, topic_messages


def messages(spark, *pairs):
    return spark.createDataFrame(list(pairs), "key string, value string")


def shots(spark, *numbers):
    df = landing.as_messages(frame(spark, *({"id": float(n), "match_id": float(n % 3)} for n in numbers)))
    return df.selectExpr("get_json_object(value, '$.match_id') as key", "value")


def test_offsets_go_on_without_gaps_and_keys_stay_together(spark, tmp_path):
    topic = str(tmp_path / "topic")
    assert publish_to_topic(messages(spark, *((f"k{n % 5}", str(n)) for n in range(40))), topic, 3) == 40
    assert publish_to_topic(messages(spark, (None, "x"), (None, "y"), ("k1", "z"), ("", "e")), topic, 3) == 4
    assert publish_to_topic(messages(spark), topic, 3) == 0
    rows = spark.read.parquet(topic).collect()
    where = {}
    for r in rows:
        where.setdefault(r.partition, []).append(r.offset)
    assert all(sorted(found) == list(range(len(found))) for found in where.values()) and len(rows) == 44
    by_key = {}
    for r in rows:
        if r.key is not None:
            by_key.setdefault(r.key, set()).add(r.partition)
    assert all(len(places) == 1 for places in by_key.values())
    second = {(r.partition, r.offset) for r in rows if r.value in ("x", "y", "z", "e")}
    first = {(r.partition, r.offset) for r in rows if r.value not in ("x", "y", "z", "e")}
    assert all(max((o for q, o in first if q == p), default=-1) < o for p, o in second)


def test_a_restart_goes_on_in_the_middle_of_the_topic(spark, tmp_path):
    topic, table, progress = (str(tmp_path / n) for n in ("topic", "t", "p"))
    publish_to_topic(shots(spark, 1, 2, 3), topic)
    publish_to_topic(messages(spark, ("k", "not json")), topic)

    def run():
        stream.run_shot_stream(topic_messages(spark, topic).select("value"), table, progress)

    run()
    assert ids(stream.scan_events(spark, table)) == [1.0, 2.0, 3.0]
    publish_to_topic(shots(spark, 4, 5), topic)
    run()
    run()
    assert ids(stream.scan_events(spark, table)) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert stream.scan_bad_events(spark, table).count() == 1
    again, other = str(tmp_path / "t2"), str(tmp_path / "p2")
    stream.run_shot_stream(topic_messages(spark, topic).select("value"), again, other)  # from the beginning
    assert ids(stream.scan_events(spark, again)) == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_key_partition_and_offset_come_along(spark, tmp_path):
    topic = str(tmp_path / "topic")
    publish_to_topic(messages(spark, ("a", json.dumps(shot())), ("a", "b"), (None, "c")), topic, 1)
    query = topic_messages(spark, topic).writeStream.format("memory").queryName("topic_rows").start()
    try:
        query.processAllAvailable()
        got = spark.table("topic_rows").collect()
    finally:
        query.stop()
    assert sorted(r.offset for r in got) == [0, 1, 2] and {r.partition for r in got} == {0}
    assert {(r.key, r.value) for r in got} == {("a", json.dumps(shot())), ("a", "b"), (None, "c")}


def test_a_topic_without_messages(spark, tmp_path):
    table = str(tmp_path / "t")
    stream.run_shot_stream(topic_messages(spark, str(tmp_path / "none")).select("value"), table, str(tmp_path / "p"))
    assert stream.scan_events(spark, table).count() == 0


def test_every_row_has_an_outcome(spark, tmp_path):
    topic = str(tmp_path / "topic")
    df = messages(spark, ("a", "fits"), ("b", None), ("c", "x" * 50), (None, "é" * 10), (None, "é" * 11), ("a", "fits"))
    report = publish_with_report(df, topic, 1, max_bytes=20).collect()
    assert sorted((str(r.key), r.partition, r.error) for r in report if r.error) == [
        ("None", None, "22 bytes"), ("b", None, "no value"), ("c", None, "50 bytes"),
    ]
    sent = [r for r in report if r.error is None]
    assert sorted(r.offset for r in sent) == [0, 1, 2] and sorted(str(r.key) for r in sent) == ["None", "a", "a"]
    assert {r.value for r in spark.read.parquet(topic).collect()} == {"fits", "é" * 10}
    assert [r.error for r in publish_with_report(messages(spark, ("z", None)), topic).collect()] == ["no value"]
    assert publish_with_report(messages(spark), topic).collect() == []


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topics, "SPLIT", 20_000)
    monkeypatch.setattr(topics, "ROW_GROUP", 20_000)
    topic = str(tmp_path / "topic")
    texts = spark.range(2000).selectExpr("'k' as key", "concat(id, ' ', sha2(cast(id as string), 512)) as value")
    assert publish_to_topic(texts, topic, 1) == 2000
    batches = []

    def note(batch, _):
        found = batch.withColumn("task", F.spark_partition_id()).select("task", "offset").collect()
        batches.append(([r.offset for r in found], len({r.task for r in found})))

    query = topic_messages(spark, topic).writeStream.foreachBatch(note).trigger(availableNow=True).start()
    query.awaitTermination()
    ((offsets, tasks),) = batches
    assert sorted(offsets) == list(range(2000)) and tasks > 3

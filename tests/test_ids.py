from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import clean_frame, plan, rows
from touchline.operators import ids, joins
from touchline.operators.star import Star
from touchline.schemas import LABEL_KEYS


def test_codes_rank_sorted_values(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "a", None, "C", "b", "é")], "v string")
    book = ids.assign_codes(df, ["v"])
    assert rows(book.select("value", "code")) == [("C", 0), ("a", 1), ("b", 2), ("é", 3), (None, -1)]
    got = ids.attach_codes(df, book, {"v": "v_id"})
    assert sorted(r.v_id for r in got.collect()) == [-1, 0, 1, 2, 2, 3]


def test_codes_of_a_column_without_values(spark):
    df = spark.createDataFrame([(None, "x")], "v string, w string")
    assert rows(ids.assign_codes(df, ["v", "w"])) == [("v", None, -1), ("w", "x", 0)]


def test_stable_codes_keep_and_append(spark):
    old = ids.assign_codes(spark.createDataFrame([("m",), ("k",), (None,)], "v string"), ["v"])
    more = spark.createDataFrame([("a",), ("m",), ("z",), (None,)], "v string")
    book = ids.assign_codes_stable(more, ["v"], old)
    assert rows(book.select("value", "code")) == [("a", 2), ("k", 0), ("m", 1), ("z", 3), (None, -1)]
    again = ids.assign_codes_stable(more, ["v"], book)
    assert rows(again) == rows(book)


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    got = ids.dense_ids(df, ["k"], "n", start=10).orderBy("k").collect()
    assert [r.n for r in got] == list(range(10, 5010))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_dense_ids_without_coalescing(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(300).select((-F.col("id")).alias("k"), F.lit("x").alias("v"))
        got = ids.dense_ids(df, ["k"], "n")
        assert [r.n for r in got.orderBy("k").collect()] == list(range(300))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_dense_ids_of_nothing(spark):
    assert ids.dense_ids(spark.createDataFrame([], "k int"), ["k"], "n").count() == 0


def test_factorize_by_first_appearance(spark):
    df = clean_frame(
        spark,
        {"player_id": 1, "games": 1},
        {"player_id": 2, "games": 1},
        {"player_id": 3, "games": 2},
        {"player_id": 4, "games": 1},
        {"player_id": 5, "games": None},
        {"player_id": 6, "games": None},
    )
    for small in (True, False):
        got = ids.factorize_stat_line(df, small=small).select("player_id", "pstatistics_id")
        assert rows(got) == [(1, 0), (2, 0), (3, 1), (4, 0), (5, 2), (6, 2)]


def test_stat_line_fact_keeps_first_of_equal_lines(spark):
    df = clean_frame(spark, {"player_id": 2}, {"player_id": 1}, {"player_id": 3, "games": 4})
    by_line = Star(df, "stat_line").fact.select("pstatistics_id", "player_id")
    assert rows(by_line) == [(0, 1), (1, 3)]
    by_grain = Star(df).fact.select("pstatistics_id", "player_id")
    assert rows(by_grain) == [(0, 1), (1, 2), (2, 3)]


def test_unknown_fact_key(spark):
    with pytest.raises(ValueError):
        Star(clean_frame(spark, {}), "no such key").fact  # noqa: B018


def skewed(spark, n=4000):
    """One key holds a third of the rows, another third has no key, the rest is spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500)
    return spark.range(n, numPartitions=4).select("id", key.cast("int").alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(400).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    assert rows(joins.spread_join(left, right, "k", how)) == rows(left.join(right, "k", how))


def test_spread_join_deals_the_hot_key_out(spark):
    left = skewed(spark)
    right = spark.range(400).select(F.col("id").cast("int").alias("k"), F.lit("w").alias("w"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    try:
        joined = joins.spread_join(left, right, "k")
        tasks = joined.where("k = 7").select(F.spark_partition_id()).distinct().count()
        plain = left.join(right, "k").where("k = 7").select(F.spark_partition_id()).distinct().count()
        assert plain == 1
        assert tasks > 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_hot_keys_are_bounded_and_complete(spark):
    found = joins.hot_hashes(skewed(spark), "k")
    hot = spark.createDataFrame([(7,)], "k int").select(F.xxhash64("k")).first()[0]
    assert hot in found
    assert len(found) <= 1 / joins.HOT_SHARE


def test_no_hot_keys_no_salt(spark):
    left = spark.range(5000).select("id", F.col("id").alias("k"))
    right = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left"):
        assert joins.spread_join(left, right, "k", how).where("w = 2 * id").count() == 5000


def test_size_check(spark):
    small = spark.createDataFrame([(1, "a")], "k int, v string")
    big = spark.range(1000).select(F.col("id").alias("k"), F.lit("x" * 100).alias("v"))
    assert joins.fits_broadcast({"s": small, "b": big}, limit=10_000) == {"s": True, "b": False}


def test_attach_codes_beyond_broadcast(spark):
    df = clean_frame(spark, *({"player_id": i, "team_title": f"T{i % 3}", "league": None} for i in range(30)))
    book = ids.assign_codes(df, list(LABEL_KEYS))
    columns = ["player_id", *LABEL_KEYS.values()]
    wide = ids.attach_codes(df, book, LABEL_KEYS, small=False).select(*columns)
    assert rows(wide) == rows(ids.attach_codes(df, book, LABEL_KEYS, small=True).select(*columns))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.text("ab", max_size=2)), min_size=1, max_size=20))
def test_keep_first_and_last(spark, data):
    df = spark.createDataFrame(data, "k int, pos int, v string")
    first, last = {}, {}
    for k, pos, v in sorted(data):
        first.setdefault(k, (k, pos, v))
        last[k] = (k, pos, v)
    assert rows(ids.keep_first(df, ["k"], ["pos"])) == sorted(first.values(), key=str)
    assert rows(ids.keep_last(df, ["k"], ["pos"])) == sorted(last.values(), key=str)


def test_keep_first_reduces_before_the_shuffle(spark):
    text = plan(ids.keep_first(skewed(spark).withColumn("v", F.col("id")), ["k"], ["id"]), "SIMPLE")
    assert text.index("Exchange hashpartitioning") < text.index("partial_min")

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from cases import ODD, documents, store
from touchline.llm.sharding import (
    assign_shards,
    equal_weights,
    number_slots,
    op1_rendezvous_sharding,
    write_shards,
)


def placed(spark, n, weights):
    df = assign_shards(spark.range(n), ["id"], weights)
    return {r.id: r.shard for r in df.collect()}


def test_one_shard_more_takes_rows_only_into_itself(spark):
    few, more = placed(spark, 5000, equal_weights(7)), placed(spark, 5000, equal_weights(8))
    moved = {more[k] for k in few if few[k] != more[k]}
    assert moved == {7}
    assert abs(sum(s == 7 for s in more.values()) - 5000 / 8) < 120


def test_one_shard_less_moves_only_its_own_rows(spark):
    weights = {s: 1.0 for s in (3, 4, 9)}
    before = placed(spark, 3000, weights)
    after = placed(spark, 3000, {3: 1.0, 9: 1.0})
    assert all(after[k] == s for k, s in before.items() if s != 4)


def test_weights_set_the_shares(spark):
    counts = Counter(placed(spark, 20000, {0: 1.0, 1: 2.0, 2: 5.0, 3: 0.0}).values())
    assert 3 not in counts
    for shard, weight in ((0, 1), (1, 2), (2, 5)):
        assert abs(counts[shard] / 20000 - weight / 8) < 0.015


def test_no_weight_is_refused(spark):
    with pytest.raises(ValueError):
        assign_shards(spark.range(1), ["id"], {0: 0.0})


def test_slots_are_gapless_with_a_hot_key(spark):
    df = spark.range(3000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"), F.lit("x").alias("_at")
    )
    slots = number_slots(assign_shards(df, ["id"], equal_weights(4)))
    assert slots.columns == ["id", "_at", "shard", "slot"]
    seen = {}
    for r in slots.collect():
        seen.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())
    assert sum(map(len, seen.values())) == 3000


def test_query_on_odd_rows(spark, tmp_path):
    sf = store(documents(spark, ODD), tmp_path)
    rows = op1_rendezvous_sharding(spark, sf).collect()
    assert len(rows) == len(ODD)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in ODD)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) for r in rows)
    by_key = {}
    for r in rows:
        by_key.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
    assert all(len(v) == 1 for v in by_key.values())


def test_empty_table(spark, tmp_path):
    assert op1_rendezvous_sharding(spark, store(documents(spark, []), tmp_path)).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    df = assign_shards(spark.range(500), ["id"], equal_weights(3))
    write_shards(df, f"{tmp_path}/out", files_per_shard=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("id", "shard").collect())) == sorted(map(tuple, df.collect()))


def brute_shard(key: int | None, weights: dict[int, float]) -> int:
    """The best of all draws, each a hash of key and shard in eight bytes (a null key is skipped)."""

    def draw(shard: int) -> float:
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        bits = xxhash.xxh64_intdigest(struct.pack("<q", shard), seed) >> 11
        return -weights[shard] / math.log((bits + 0.5) * 2.0**-53)

    return max((s for s in weights if weights[s] > 0), key=lambda s: (draw(s), -s))


def test_shards_match_a_plain_computation(spark):
    keys = [*range(-50, 400), 2**40, -(2**62), None]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    for weights in (equal_weights(24), equal_weights(25), {0: 1.0, 3: 5.0, 7: 0.0, 9: 2.5}):
        got = {r.key: r.shard for r in assign_shards(df, ["key"], weights).collect()}
        assert got == {k: brute_shard(k, weights) for k in keys}

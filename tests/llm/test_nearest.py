from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import store
from helpers import plan
from touchline.llm import nearest as search
from touchline.llm.nearest import _bounds, _Side, layout, nearest, op9_block_matrix_search


def brute(rows, k):
    """(query position, rank, candidate id, score) by a loop over all pairs."""
    good = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = [(i, v) for i, v in rows if good(v)]
    out = []
    for q, a in rows:
        if q is None or q % 20:
            continue
        scored = []
        for c, b in rows:
            if c != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b):
                    total += x * y
                scored.append((-total, math.inf if c is None else c, c))
        for rank, (s, _, c) in enumerate(sorted(scored)[:k], 1):
            out.append((q, rank, c, -s))
    return sorted(out, key=str)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def check(spark, rows, k, kind="double", **options):
    df = frame(spark, [(i, v, 0) for i, v in rows], kind)
    got = nearest(df.where(F.col("vec_id") % 20 == 0), df, "vec_id", "embedding", k, **options)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k)


def vectors(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=dim).round(4).tolist()) for i in range(n)]


@pytest.mark.parametrize("block, stripe", [(3, 10**6), (1024, 10**6), (4, 40)])
def test_matches_brute_force(spark, block, stripe):
    check(spark, vectors(300, 17), 20, block=block, stripe=stripe)


def test_many_queries_in_a_cell(spark, monkeypatch):
    rows = [(20 * i if i % 2 else i, v) for i, v in vectors(200, 5)]
    want = brute(rows, 20)
    found = []
    for size in (1, 7):  # as tasks do, in this process
        monkeypatch.setattr(search, "_ROWS", size)
        monkeypatch.setattr(search, "_TILE", 13)
        asked = [(n, i, v) for n, (i, v) in enumerate(rows) if i % 20 == 0]
        batch = lambda part, kind: pa.RecordBatch.from_pydict(
            {"dim": [5] * len(part), "cell": [0] * len(part), "is_candidate": [kind] * len(part), "row": [p[0] for p in part],
             "id": [p[1] for p in part], "vector": [p[2] for p in part]}
        )
        out = search._searcher(20)(iter([batch(asked, 0), batch([(n, i, v) for n, (i, v) in enumerate(rows)], 1)]))
        rows_of = [tuple(r.values()) for b in out for r in b.to_pylist()]
        found.append(sorted((q, c, s) for _, q, c, s in rows_of))
    assert found[0] == found[1] == sorted((q, c, s) for q, _, c, s in want)


def test_no_task_holds_more_than_asked_for():
    for queries, candidates in ((1_600_000, 32_000_000), (1, 1), (0, 0), (10**6, 3 * 10**5)):
        blocks, stripes = layout(queries, candidates, 6)
        assert queries / blocks <= 16_384 and candidates / stripes <= 262_144 and blocks * stripes >= 12
    assert layout(1_600_000, 32_000_000, 6) == (98, 123)


def test_rows_are_dealt_over_blocks_and_stripes(spark):
    df = frame(spark, [(i, v, 0) for i, v in vectors(400, 3)], "double")
    text = plan(nearest(df, df, "vec_id", "embedding", 5, block=4, stripe=100))
    assert "hashpartitioning(dim" in text and "400)" in text  # 100 blocks, 4 stripes


def test_ties_and_a_hot_vector(spark):
    rows = vectors(120, 4)
    rows = [(i, rows[0][1] if i % 3 else v) for i, v in rows]
    check(spark, rows, 20)


def test_odd_vectors(spark):
    rows = vectors(45, 3) + [
        (100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [float("nan"), 1.0, 1.0]),
        (180, [float("inf"), 1.0, 1.0]), (200, [1.0, 2.0]), (201, [2.0, 1.0]), (220, []), (None, [9.0, 9.0, 9.0]),
        (5, [3.0, 3.0, 3.0]), (5, [3.0, 3.0, 3.0]), (300, [1e300, 1.0, 1.0]), (301, [1e-300, 0.0, 0.0]),
    ]
    check(spark, rows, 20)


def test_fewer_candidates_than_asked_for(spark):
    check(spark, vectors(5, 6), 20)
    check(spark, vectors(1, 6), 20)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(40, 64)), rng.normal(size=(60, 64)) * rng.uniform(0.001, 1000, (60, 1))
    low, high = _bounds(_Side(q), _Side(c))
    assert (low <= q @ c.T).all() and (q @ c.T <= high).all()
    assert (high - low < 0.05 * np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1))).all()


def test_empty_table(spark, tmp_path):
    assert op9_block_matrix_search(spark, store(frame(spark, []), tmp_path, "embeddings")).count() == 0


def test_other_columns_of_any_name(spark):
    df = frame(spark, [(i, v, 0) for i, v in vectors(30, 4)], "double").withColumnRenamed("label", "row")
    df = df.withColumn("dim", F.lit("x")).withColumn("_stripe", F.lit(3))
    got = nearest(df.where(F.col("vec_id") % 20 == 0), df, "vec_id", "embedding", 3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(vectors(30, 4), 3)

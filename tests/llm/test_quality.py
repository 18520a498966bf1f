from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import ODD, documents, store
from touchline.llm import quality
from touchline.llm.quality import (
    FILTERS,
    HALF,
    UNITS,
    VECTOR,
    WIDTH,
    Model,
    State,
    _parts,
    _SIZE,
    gradient,
    initial,
    labelled_sample,
    op12_byte_network,
    score,
    train,
)

LABELS = "doc_id long, quality int, toxic int"


def brute_score(flat: np.ndarray, text: str) -> float:
    """The network place by place, in double precision."""
    parts = {k: v.astype(float) for k, v in _parts(flat).items()}
    data = list(text.encode())
    halves = max(2, -(-len(data) // HALF))
    data += [256] * (halves * HALF + WIDTH - 1 - len(data))
    kernels = parts["filters"].reshape(WIDTH, VECTOR, FILTERS)
    best = [-np.inf] * UNITS
    for chunk in range(halves - 1):
        kept = np.full(FILTERS, -np.inf)
        for place in range(chunk * HALF, (chunk + 2) * HALF):
            answer = sum(parts["vectors"][data[place + w]] @ kernels[w] for w in range(WIDTH))
            kept = np.maximum(kept, answer)
        kept = np.maximum(kept + parts["filter_bias"], 0)
        units = np.maximum(kept @ parts["units"] + parts["unit_bias"], 0)
        best = np.maximum(best, units)
    return float(1 / (1 + np.exp(-(best @ parts["weights"] + parts["bias"][0]))))


@settings(max_examples=30, deadline=None)
@given(st.text("ab é!€ ", max_size=300), st.integers(0, 5))
def test_score_matches_the_network_place_by_place(text, seed):
    flat = initial(seed)
    assert Model(flat).score(text) == pytest.approx(brute_score(flat, text), abs=1e-5)


def test_long_texts_are_looked_at_in_slices(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefgh ", k=5_000))
    whole = Model(initial()).pooled(text)
    for size in (1, 2, 7):
        monkeypatch.setattr(quality, "_HALVES", size)
        part = Model(initial()).pooled(text)
        assert np.allclose(whole[0], part[0], atol=1e-6) and (whole[1] == part[1]).all()


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(5)
    texts, labels = ["a few words, not many!", "b" * 150 + " end", ""], np.array([1.0, 0.0, 1.0])
    flat = initial(3)

    def loss(at: np.ndarray) -> float:
        p = np.array([brute_score(at, t) for t in texts])
        return float(-np.mean(np.log(np.where(labels == 1, p, 1 - p))))

    found = gradient(flat, texts, labels)
    touched = np.flatnonzero(np.abs(found) > 1e-3)
    for at in rng.choice(touched, 25, replace=False):
        step = np.zeros(_SIZE)
        step[at] = 1e-4
        slope = (loss(flat + step) - loss(flat - step)) / 2e-4
        assert found[at] == pytest.approx(slope, abs=2e-3, rel=0.05)


def test_state_survives_the_way_to_the_tasks():
    state = State(initial(), initial(1), np.abs(initial(2)), 7)
    back = State.unpacked(state.packed(), 7)
    assert all((getattr(state, n) == getattr(back, n)).all() for n in ("flat", "mean", "square"))


def corpus(n: int, seed: int):
    """Ordinary texts, and texts that are loud, marked up, or say one word again and again."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghilmnoprstuv", k=rng.randint(2, 9))) for _ in range(3000)]
    rows = []
    for i in range(n):
        body = rng.choices(words, k=rng.randint(20, 120))
        bad = i % 4 == 0
        if bad:
            kind = i // 4 % 3
            low = rng.randrange(len(body) // 2)
            part = body[low : low + 30]
            body[low : low + 30] = [
                [w.upper() + "!!" for w in part],
                [w + "%%%" for w in part],
                [w for w in part[:4] for _ in range(9)],
            ][kind]
        rows.append((i, " ".join(body), int(not bad)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1600, 11)
    docs = documents(spark, [(i, t, "x") for i, t, _ in rows]).repartition(3)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], LABELS)
    model = train(docs, labels)
    kept = [(t, q) for i, t, q in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(kept) > 300
    right = [(model.score(t) >= 0.7) == (q == 1) for t, q in kept]
    assert np.mean(right) > 0.93
    # By Spark as by the model.
    got = {r.doc_id: r.s for r in docs.select("doc_id", score(model, F.col("text")).alias("s")).collect()}
    assert got == {i: model.score(t) for i, t, _ in rows}


def test_held_out_rows_and_repeats_are_not_learnt_from(spark):
    docs = documents(spark, [(i, f"text {i}", "x") for i in range(60)] + [(7, "again", "x")] * 40 + [(None, "no id", "x")])
    labels = [(i, i % 2, 0) for i in range(60) if i != 8] + [(7, 1, 0)] * 5 + [(7, 0, 0), (None, 1, 0), (8, None, 0), (99, 1, 0)]
    rows = labelled_sample(docs, spark.createDataFrame(labels, LABELS)).collect()
    learnt = {i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2 and i != 8}
    assert sorted(r.text for r in rows) == sorted({f"text {i}" for i in learnt - {7}} | ({"again"} if 7 in learnt else set()))
    assert labelled_sample(docs, spark.createDataFrame(labels, LABELS), 3).count() == 6


def test_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 10)], LABELS)
    folder = store(documents(spark, ODD), tmp_path)
    store(labels, tmp_path, "labels")
    rows = op12_byte_network(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, *_ in ODD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    by = {}
    for (i, t, _), r in zip(sorted(ODD, key=str), sorted(rows, key=lambda r: str(r.doc_id))):
        by.setdefault(i, set()).add(r.score)
    assert by[2] == by[3] and len(by[6]) == 1


@pytest.mark.parametrize("known", [[], [(1, 1, 0)], [(None, 0, 0), (5, None, 1)]])
def test_without_both_classes_every_text_scores_one_half(spark, tmp_path, known):
    docs = documents(spark, ODD).withColumnRenamed("lang", "key").withColumnRenamed("n_chars", "good")
    model = train(docs, spark.createDataFrame(known, LABELS))
    assert model.score("anything") == 0.5


def test_empty_tables(spark, tmp_path):
    folder = store(documents(spark, []), tmp_path)
    store(spark.createDataFrame([], LABELS), tmp_path, "labels")
    assert op12_byte_network(spark, folder).collect() == []

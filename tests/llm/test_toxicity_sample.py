"""What the classifier learns from: whole texts, one for each key."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cases import documents, store
from test_toxicity import INSULTS, LABELS, SYLLABLES, texts
from touchline.llm.toxicity import NO_CUT, STAGE_PRECISION, _cut, fit, labelled_sample, train, without_toxic


def tables(spark, folder, rows, labels):
    sf = store(documents(spark, [(i, t, "x") for i, t in rows]), folder)
    spark.createDataFrame([(i, 1, c) for i, c in labels], LABELS).write.parquet(f"{sf}/labels.parquet")
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_wording_late_in_long_texts_is_learnt(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
    long = lambda: " ".join(word() for _ in range(4_500))
    bodies = [(i, f"{long()} {' '.join(rng.choices(INSULTS, k=12))}" if i % 2 else long()) for i in range(60)]
    assert min(len(t) for _, t in bodies) > 20_000
    docs, labels = tables(spark, tmp_path, bodies, [(i, i % 2) for i, _ in bodies])
    assert {r.text for r in labelled_sample(docs, labels).collect()} <= {t for _, t in bodies}
    model = train(docs, labels)
    assert all(word.encode() in model.toxic for word in INSULTS)


def test_a_repeated_key_counts_once(spark, tmp_path):
    bodies = list(enumerate(texts(60)))
    labels = [(i, int(i % 3 == 0)) for i, _ in bodies]
    once = train(*tables(spark, tmp_path / "a", bodies, labels))
    docs, known = tables(spark, tmp_path / "b", bodies + [bodies[3]] * 500, labels)
    assert labelled_sample(docs, known).where("toxic = 1").count() <= 20
    assert train(docs, known) == once


def test_the_cut_of_the_stage_is_the_lowest_that_is_precise():
    scores = np.array([0.99, 0.9, 0.8, 0.8, 0.7, 0.6, 0.2])
    labels = np.array([1.0, 1, 1, 1, 1, 0, 1])
    assert _cut(scores, labels, np.ones(7), 1) == 0.7
    assert _cut(scores, np.array([1.0, 1, 1, 0, 1, 1, 0]), np.ones(7), 1) == 0.9
    assert _cut(scores, np.array([1.0, 1, 1, 1, 1, 1, 0]), np.ones(7), 1) == 0.5
    assert _cut(scores, np.zeros(7), np.ones(7), 1) == NO_CUT
    assert _cut(np.full(3, 0.1), np.ones(3), np.ones(3), 1) == NO_CUT
    assert _cut(scores, labels, np.ones(7)) == NO_CUT  # so few texts tell nothing
    many = np.repeat(scores, 6)
    assert _cut(many, np.repeat(labels, 6), np.ones(42)) == 0.7


def test_the_stage_drops_few_clean_documents(spark, tmp_path):
    rng = random.Random(5)
    bodies = list(enumerate(texts(900)))
    labels = {i: int(i % 3 == 0) for i, _ in bodies}
    for i in rng.sample([i for i in labels if i % 3], 200):  # ordinary texts with the same words
        bodies[i] = (i, f"{bodies[i][1]} {rng.choice(INSULTS)} {rng.choice(INSULTS)}")
    docs, known = tables(spark, tmp_path, bodies, list(labels.items()))
    model = train(docs, known)
    score = {i: model.score(t) for i, t in bodies}
    kept = {r.doc_id for r in without_toxic(docs, known).collect()}
    wrong = lambda gone: sum(i % 3 != 0 for i in gone) / max(len(gone), 1)
    assert kept == {i for i in score if score[i] < model.cut}
    assert model.cut > 0.5 and wrong(set(score) - kept) < wrong([i for i in score if score[i] >= 0.5])


def test_the_cut_weighs_the_classes_by_all_labels():
    body = texts(600)
    ordinary = [t if i % 10 else f"{t} {INSULTS[0]} {INSULTS[1]}" for i, t in enumerate(body) if i % 3]
    toxic = body[::3]
    assert fit(toxic, ordinary, (200, 40_000)).cut >= fit(toxic, ordinary).cut and 0 < STAGE_PRECISION < 1


@pytest.mark.parametrize("share", [0.2, 0.6])
def test_labels_without_any_signal_drop_nothing(spark, tmp_path, share, caplog):
    rng = random.Random(8)
    bodies = [(i, " ".join("".join(rng.choices(SYLLABLES, k=3)) for _ in range(60))) for i in range(400)]
    docs, known = tables(spark, tmp_path, bodies, [(i, int(rng.random() < share)) for i, _ in bodies])
    assert without_toxic(docs, known).count() == 400
    assert "no document is dropped" in caplog.text


def test_without_labels_nothing_is_dropped(spark, tmp_path):
    docs, known = tables(spark, tmp_path, list(enumerate(texts(30))), [(1, 1), (2, 1)])
    assert without_toxic(docs, known).count() == 30

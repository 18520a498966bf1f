from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import zstandard

from cases import ODD, documents, store
from touchline.llm.toxicity import (
    MAX_SAMPLE,
    fit,
    labelled_sample,
    op8_compression_distance,
    toxic_wording,
    train,
    windows,
    without_toxic,
)

LABELS = "doc_id long, quality int, toxic int"
SYLLABLES = "ba de fi go ku la me no pi ra su te vo wi".split()
INSULTS = ["blockhead", "nitwit", "dunderpate"]


def texts(n, seed=0):
    """Invented prose; every third text has some insults."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(30, 120))]
        if i % 3 == 0:
            for at in rng.sample(range(len(words)), 4):
                words[at] = rng.choice(INSULTS)
        out.append(" ".join(words))
    return out


def corpus(spark, folder, n=600, rows=()):
    body = texts(n)
    sf = store(documents(spark, [(i, t, "x") for i, t in enumerate(body)] + list(rows)), folder)
    labels = [(i, 1, int(i % 3 == 0)) for i in range(n)]
    spark.createDataFrame(labels + [(5000, 1, None), (None, 1, 1)], LABELS).write.parquet(f"{folder}/labels.parquet")
    return sf


def test_windows_hold_every_word_once():
    text = " A b\nC d e f g h i j\tk l m "
    assert b"".join(windows(text)).split() == text.lower().encode().split()
    assert windows("") == windows(" \n") == []


def test_wording_is_what_tells(spark):
    body = texts(300)
    found = {f.strip() for f in toxic_wording(body[::3], [t for i, t in enumerate(body) if i % 3])}
    assert found == {w.encode() for w in INSULTS}


def test_copies_teach_nothing_new():
    body = texts(120)
    family = [f"{body[0]} {i} zazaza" for i in range(60)]
    found = toxic_wording(body[::3] + family, [t for i, t in enumerate(body) if i % 3])
    assert b" zazaza" not in b" ".join(found)


def test_held_out_accuracy(spark, tmp_path):
    sf = corpus(spark, tmp_path)
    rows = op8_compression_distance(spark, sf).collect()
    assert len(rows) == 600
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark, tmp_path):
    sf = corpus(spark, tmp_path)
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic"
    )
    assert train(docs, labels) == train(docs.repartition(5), turned)
    assert labelled_sample(docs, labels, 10).count() == 20 and MAX_SAMPLE > 10


def test_toxic_documents_go(spark, tmp_path):
    sf = corpus(spark, tmp_path)
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    left = without_toxic(docs, labels)
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.collect()}
    assert len(ids & set(range(0, 600, 3))) < 10 and len(ids) > 380


def test_odd_rows_and_nothing_to_learn(spark, tmp_path):
    odd = [(i if i is None else i + 10_000, t, s) for i, t, s in ODD]
    rows = op8_compression_distance(spark, corpus(spark, tmp_path / "a", rows=odd)).collect()
    scores = {r.doc_id: r.score for r in rows}
    assert len(rows) == 610 and scores[10_002] == scores[10_003] < 0.5
    sf = store(documents(spark, ODD), tmp_path / "b")
    spark.createDataFrame([], LABELS).write.parquet(f"{sf}/labels.parquet")
    assert len({r.score for r in op8_compression_distance(spark, sf).collect()}) == 1
    sf = store(documents(spark, []), tmp_path / "c")
    spark.createDataFrame([], LABELS).write.parquet(f"{sf}/labels.parquet")
    assert op8_compression_distance(spark, sf).count() == 0


def test_one_class_alone_gives_one_score():
    assert fit([], ["a b c"]).score("a") == fit(["a"], []).score("anything")


def wide(n, seed):
    """Toxic texts that use six of 600 unlike words each, so that no word is in many; and ordinary ones."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(600)]
    rng = random.Random(seed)

    def text(toxic):
        out = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(80)]
        for _ in range(6 * toxic):
            out.insert(rng.randrange(len(out)), rng.choice(words))
        return " ".join(out)

    return [text(True) for _ in range(n)], [text(False) for _ in range(n)]


def test_a_wide_vocabulary_is_learnt():
    model = fit(*wide(1000, 5))
    toxic, ordinary = ([model.score(t) >= 0.5 for t in texts] for texts in wide(300, 6))
    assert np.mean(toxic) > 0.7 and np.mean(ordinary) < 0.2


def test_scores_match_a_plain_computation():
    body = texts(200)
    model = fit(body[::3], [t for i, t in enumerate(body) if i % 3])

    def length(content, part, kind):
        known = zstandard.ZstdCompressionDict(content, dict_type=kind)
        coder = zstandard.ZstdCompressor(
            level=3, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        return len(coder.compress(part))

    for text in [*body[:25], "", " ", "Blockhead, NITWIT " * 9]:
        words = text.lower().encode().split()
        parts = [b" " + b" ".join(words[i : i + 8]) + b" " for i in range(0, len(words), 8)]
        raw, auto = zstandard.DICT_TYPE_RAWCONTENT, zstandard.DICT_TYPE_AUTO
        saved = [length(model.ordinary, p, raw) - length(model.toxic, p, raw) - model.threshold for p in parts]
        apart = [length(model.trained_ordinary, p, auto) - length(model.trained_toxic, p, auto) for p in parts]
        n, above = max(len(parts), 1), sum(x for x in saved if x > 0)
        figures = [
            1,
            math.log1p(above),
            above / n,
            sum(apart) / n,
            math.log1p(sum(x - 1 for x in apart if x > 1)),
            sum(x - 2 for x in apart if x > 2) / n,
        ]
        score = 1 / (1 + math.exp(-sum(a * b for a, b in zip(model.curve, figures))))
        assert model.score(text) == pytest.approx(score, abs=1e-9)


def test_other_columns_of_any_name(spark, tmp_path):
    sf = corpus(spark, tmp_path, 90)
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    clashing = docs.withColumnRenamed("lang", "toxic").withColumnRenamed("n_chars", "score")
    assert train(clashing, labels) == train(docs, labels)
    assert without_toxic(clashing, labels).columns == clashing.columns

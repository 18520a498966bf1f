"""The pipeline against its stages done by brute force, on a corpus with a case of everything."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from cases import DOCUMENTS, store
from test_near_duplicates import brute as grouped
from test_packing import check as check_packed
from test_repeats import LENGTH
from test_toxicity import INSULTS, LABELS, SYLLABLES
from touchline.llm.token_ids import TokenIds
from touchline.llm.toxicity import train

SOURCES = ["a", "b", None]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """360 documents: a third toxic, near copies, passages that many share, and odd rows."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randint(2, 4)))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(360):
        words = [word() for _ in range(rng.randint(60, 140))]
        if i % 3 == 0:
            for at in rng.sample(range(len(words)), 5):
                words[at] = rng.choice(INSULTS)
        elif i % 10 == 1:
            words[20:20] = [passage]
        elif i % 10 == 2 and i > 32:
            words = rows[i - 30][1].split()[:-1] + [word()]
        elif i % 10 == 4 and i > 34 and (i - 35) % 3:  # near copies between 80 and 85 of 100 shingles: one word changed
            words = rows[i - 40 + 5][1].split()[:53]
            rows[i - 40 + 5] = (*rows[i - 40 + 5][:1], " ".join(words), *rows[i - 40 + 5][2:])
            words = words[:20] + [word()] + words[21:]
        rows.append((i, " ".join(words), "en", SOURCES[i % 7 % 3], 0))
    rows += [(400, None, "en", "a", None), (401, "", "en", "a", 0), (402, "few words", "en", "b", 9)]
    folder = tmp_path_factory.mktemp("pipeline")
    sf = store(spark.createDataFrame(rows, DOCUMENTS).repartition(3), folder)
    labels = [(i, 1, int(i % 3 == 0)) for i in range(0, 360, 2)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{sf}/labels.parquet")
    return sf


def texts(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def cut(rows):
    """Texts without every window that a smaller doc_id has, by a table of all windows (ASCII)."""
    least = {}
    for i, t, _ in rows:
        for at in range(len(t or "") - LENGTH + 1):
            least[t[at : at + LENGTH]] = min(i, least.get(t[at : at + LENGTH], i))
    out = Counter()
    for i, t, s in rows:
        gone = set()
        for at in range(len(t or "") - LENGTH + 1):
            if least[t[at : at + LENGTH]] < i:
                gone.update(range(at, at + LENGTH))
        out[i, t if t is None else "".join(c for at, c in enumerate(t) if at not in gone), s] += 1
    return out


def mixed(rows):
    """Shares by repeated resharing in fractions; documents in the order of their hashes."""
    size = {r: len((r[1] or "").split()) for r in rows}
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    have = {s: sum(size[r] for r in rows if r[2] == s) for s in sources}
    weight = {s: Fraction(1 + n % 3) for n, s in enumerate(sources)}
    target, open_, rest = {}, set(sources), Fraction(sum(have.values()))
    while True:
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * have[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s], rest = Fraction(3 * have[s]), rest - 3 * have[s]
        open_ -= full
    taken = Counter()
    for s in sources:
        epochs = min(3, target[s] // have[s])
        budget, used = target[s] - epochs * have[s], 0
        own = sorted((r for r in rows if r[2] == s), key=lambda r: hashlib.md5(f"{r[0]}:{r[1] or ''}".encode()).hexdigest())
        for r in own:
            more = budget > 0 and (used + size[r] <= budget or 0 <= budget - used > used + size[r] - budget)
            used = used + size[r] if more or used + size[r] <= budget else np.inf
            taken[r] += epochs + more
    return +taken


def test_stages_match_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    given = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    model = train(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, corpus)
        assert after.columns == docs.columns
        after.write.parquet(f"{corpus}/{name}")
        docs = spark.read.parquet(f"{corpus}/{name}")
        steps[name] = texts(docs)

    clean = [r for r in given if model.score(r[1] or "") < model.cut]
    assert steps["toxicity"] == Counter(clean)
    assert sum(i % 3 == 0 for i, _, _ in clean) < 10 and sum(i % 3 != 0 for i, _, _ in clean) > 230

    kept = {i for i, _, _, keep in grouped(clean, 80) if keep}
    assert len(kept) < sum(keep for *_, keep in grouped(clean)) - 5  # what links between 80 and 85
    assert steps["near_duplicates"] == Counter(r for r in clean if r[0] in kept) and len(kept) < len(clean) - 20

    assert steps["repeats"] == cut([r for r in clean if r[0] in kept])
    assert steps["mixing"] == mixed(list(steps["repeats"]))

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    known = TokenIds(corpus_pipeline.packing.default_tokenizer())
    lengths, copies = defaultdict(int), Counter()
    for (i, t, _), n in steps["mixing"].items():
        lengths[i], copies[i] = len(known.of([t or ""])[0]) + 1, n
    for r in pieces:
        assert r.doc_tokens == lengths[r.doc_id]
    assert sum(r.length for r in pieces) == sum(lengths[i] * n for i, n in copies.items())
    check_packed(pieces, {})


def test_run_is_the_stages(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    again = corpus_pipeline.run(spark, corpus).collect()
    figures = lambda found: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in found)
    assert rows and figures(rows) == figures(again)


def test_no_documents(spark, tmp_path):
    sf = store(spark.createDataFrame([], DOCUMENTS), tmp_path)
    spark.createDataFrame([], LABELS).write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

import touchline.llm.repeats as repeats
from cases import ODD, documents, store
from touchline.llm.repeats import (
    _bucket,
    LENGTH,
    find_repeats,
    mark_repeats,
    maximal_repeats,
    op6_common_prefix_intervals,
    runs,
    without_repeats,
)


def brute(rows):
    """Per row (doc_id, n_bytes, n_removed, n_spans, kept_sha256) by a table of all windows."""
    last = 2**63 - 1
    least = {}
    for i, t, _ in rows:
        raw, i = (t or "").encode(), last if i is None else i
        for at in range(len(raw) - LENGTH + 1):
            w = raw[at : at + LENGTH]
            least[w] = min(least.get(w, last), i)
    out = []
    for i, t, _ in rows:
        raw, own = (t or "").encode(), last if i is None else i
        gone = bytearray(len(raw))
        for at in range(len(raw) - LENGTH + 1):
            if least[raw[at : at + LENGTH]] < own:
                gone[at : at + LENGTH] = b"\1" * LENGTH
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (at and gone[at - 1]) for at, g in enumerate(gone))
        out.append((i, len(raw), len(raw) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    found = find_repeats(df).selectExpr("kept.doc_id", "n_bytes", "n_removed", "cast(size(starts) as long)", "kept_sha256")
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, n=60):
    """Texts that share passages of all lengths, with copies, edits, and short periods."""
    rng = random.Random(seed)
    letters = "abcdefgh é語\n"
    prose = lambda k: "".join(rng.choices(letters, k=k))
    passages = [prose(rng.randrange(30, 200)) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            if kind < 0.5:
                parts.append(prose(rng.randrange(0, 120)))
            elif kind < 0.9:
                whole = rng.choice(passages)
                low = rng.randrange(len(whole))
                parts.append(whole[low : low + rng.randrange(20, 200)])
            else:
                parts.append("ab" * rng.randrange(10, 60))
        rows.append((i * 7 % n, "".join(parts), "x"))
    rows += [(n + 1, rows[0][1], "x"), (n + 2, rows[0][1], "x"), (n + 2, rows[0][1], "x"), (None, rows[3][1], "x")]
    rows += [(n + 3, rows[1][1][:80] + "Z" + rows[1][1][81:], "x"), (3, rows[1][1], "x")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    assert digest(documents(spark, rows).repartition(3)) == brute(rows)


def test_hot_anchors_and_small_slices(spark, monkeypatch):
    rows = corpus(4)
    rows += [(200 + i, f"{i} start of its own, " + "a line that very many of the documents have, word by word" + f" end {i}", "x") for i in range(30)]
    want = brute(rows)
    # The functions run in this process' workers, so the figures are changed where they are read.
    chunk = lambda some: repeats.Chunk(repeats.pa.table({"text": [t or "" for _, t, _ in some], "id": [2**63 - 1 if i is None else i for i, _, _ in some]}))
    monkeypatch.setattr(repeats, "HOT", 5)
    monkeypatch.setattr(repeats, "_SLICE", 97)
    assert by_hand(rows) == want
    assert len(chunk(rows).runs.first) > 100


def by_hand(rows):
    """The steps of the job without Spark, over five chunks."""
    pa = repeats.pa
    ids = lambda i: 2**63 - 1 if i is None else i
    groups = {}
    for n, (i, t, _) in enumerate(rows):
        groups.setdefault(n % 5, []).append((i, t or ""))
    tables = {
        c: pa.table(
            {
                "kept": pa.array([{"doc_id": i} for i, _ in g], pa.struct([("doc_id", pa.int64())])),
                "id": pa.array([ids(i) for i, _ in g], pa.int64()),
                "text": pa.array([t for _, t in g]),
                "chunk": pa.array([c] * len(g), pa.int32()),
            }
        )
        for c, g in groups.items()
    }
    counted = pa.concat_tables([repeats._count_anchors(3)(t) for t in tables.values()])
    of = lambda table, name, value: table.filter(repeats.pc.equal(table[name], value))
    shared = pa.concat_tables([repeats._find_shared(of(counted, "bucket", b)) for b in set(counted["bucket"].to_pylist())])
    assert any(any(np.frombuffer(x.as_py(), bool)) for x in shared["hot"])
    met = pa.concat_tables([repeats._meet(3)(t, of(shared, "chunk", c)) for c, t in tables.items()])
    marks = repeats._resolve(met)
    told = pa.concat_tables([shared, marks], promote_options="default")
    out = pa.concat_tables([repeats._remover(False)(t, of(told, "chunk", c)) for c, t in tables.items()]).to_pylist()
    return sorted(((r["kept"]["doc_id"], r["n_bytes"], r["n_removed"], len(r["starts"]), r["kept_sha256"]) for r in out), key=str)


def test_query_on_odd_rows(spark, tmp_path):
    found = op6_common_prefix_intervals(spark, store(documents(spark, ODD), tmp_path / "a")).collect()
    assert sorted(map(tuple, found), key=str) == brute(ODD)
    assert op6_common_prefix_intervals(spark, store(documents(spark, []), tmp_path / "b")).count() == 0


def test_maximal_repeats_have_all_occurrences():
    rng = random.Random(5)
    core = bytes(rng.choices(b"abcd", k=60))
    blocks = [b"x" + core + b"1", b"y" + core + b"2", b"y" + core[:55] + b"3333333", core[5:] + b"2"]
    sizes = np.array([len(b) for b in blocks])
    found = {}
    for length, block, offset in maximal_repeats(np.frombuffer(b"".join(blocks), np.uint8), np.cumsum(sizes) - sizes, sizes):
        strings = {blocks[b][o : o + length] for b, o in zip(block, offset)}
        assert len(strings) == 1
        found[strings.pop()] = {(int(b), int(o)) for b, o in zip(block, offset)}
    want = {}
    for length in range(LENGTH, 80):
        for b, text in enumerate(blocks):
            for o in range(len(text) - length + 1):
                want.setdefault(text[o : o + length], set()).add((b, o))

    def maximal(string, places):
        left = {blocks[b][o - 1] if o else (b, o) for b, o in places}
        right = {blocks[b][o + len(string)] if o + len(string) < len(blocks[b]) else (b, o) for b, o in places}
        return len(places) > 1 and len(left) > 1 and len(right) > 1

    assert found == {s: p for s, p in want.items() if maximal(s, p)}
    marks = mark_repeats(np.frombuffer(b"".join(blocks), np.uint8), np.cumsum(sizes) - sizes, sizes, np.array([4, 3, 2, 1]))
    assert marks[3] == 0 and bin(int(marks[0])).count("1") == 11


def test_blocks_hold_every_window_once():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([0, 10, 10, 700, 749, 799, 2500, 5000])
    found = runs(data, ends)
    windows = [s for a, b in zip(found.first, found.last) for s in range(a, b + 1)]
    want = [s for low, high in zip([0, *ends[:-1]], ends) for s in range(low, high - LENGTH + 1)]
    assert windows == want
    assert (ends[found.doc] >= found.last + LENGTH).all()


def test_documents_stay_text(spark):
    shared = "é" * 40
    df = documents(spark, [(1, "a" + shared, "x"), (2, "ba" + shared + "語", "x"), (3, None, "x"), (4, "a" + shared, "x")])
    df = df.withColumnRenamed("lang", "kept").withColumnRenamed("source", "id")
    cut = without_repeats(df)
    assert cut.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert got == {1: ("a" + shared, 41), 2: ("b語", 2), 3: (None, None), 4: ("", 0)}


def test_n_chars_need_not_be_there(spark):
    body = "one passage of more than fifty bytes that comes twice, here and there"
    df = documents(spark, [(1, body, "x"), (2, f"2 {body}", "x"), (3, None, "x")]).drop("n_chars")
    left = without_repeats(df)
    assert left.columns == df.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: body, 2: "2 ", 3: None}


def test_buckets_get_as_many_anchors_each():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 117, 400_000, dtype=np.uint8)
    anchors = np.unique(runs(data, np.array([len(data)])).anchor)
    counts = np.bincount(_bucket(anchors, 50), minlength=50)
    assert len(counts) == 50 and counts.max() < 2 * counts.mean()
    assert (np.diff(_bucket(anchors, 50)) >= 0).all()  # ranges

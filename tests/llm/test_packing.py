from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import ODD, documents, store
from touchline.llm.packing import (
    OpenWindows,
    best_fit_decreasing,
    default_tokenizer,
    op10_best_fit_packing,
    pack_documents,
)
from touchline.llm.token_ids import TokenIds

KNOWN = TokenIds(default_tokenizer())
PLAIN = Tokenizer.from_file(default_tokenizer())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abEsStTrRvLmd'’12 \n\t!<|>éÉßÿ×ı́İΣσ\x85\x1c", max_size=30), max_size=4))
def test_ids_are_the_tokenizers(texts):
    want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in KNOWN.of(texts)] == want


@pytest.mark.parametrize("text", ["<|endoftext|> x", "x" * 200 + " " + "x" * 201, "DON'T we'll 'tis ''s !'s", "é" * 70])
def test_ids_of_special_texts(text):
    assert KNOWN.of([text])[0].tolist() == PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_matches_a_plain_search(lengths):
    lengths = sorted(lengths, reverse=True)
    number, offset = best_fit_decreasing(np.array(lengths, int), 16)
    left = []
    for at, length in enumerate(lengths):
        fits = [c for c in left if c >= length]
        best = min(fits) if fits else 16
        assert 16 - offset[at] == best
        if not fits:
            left.append(16)
        left[left.index(best)] -= length
    assert len(set(number.tolist())) == len(left)


def test_open_windows_are_found_tightest_first():
    windows = OpenWindows(10)
    for capacity, window in ((3, 1), (7, 2), (7, 3), (10, 4)):
        windows.add(capacity, window)
    assert [windows.take(4)[0] for _ in range(3)] == [7, 7, 10]
    assert windows.take(4) is None and windows.take(1) == (3, 1)


def check(rows, texts, window=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for at, text in texts.items():
        ids = np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted(pieces[at], key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) <= window
    return sequences


def test_all_tokens_are_packed_once(spark):
    rng = np.random.default_rng(4)
    texts = {i: " ".join(["token"] * int(n)) for i, n in enumerate(rng.integers(0, 5000, 400))}
    df = documents(spark, [(i, t, "x") for i, t in texts.items()]).repartition(3)
    rows = pack_documents(df).collect()
    sequences = check(rows, texts)
    tokens = sum(r.length for r in rows)
    assert tokens / (2048 * len(sequences)) > 0.98


def test_odd_rows(spark, tmp_path):
    rows = op10_best_fit_packing(spark, store(documents(spark, ODD), tmp_path / "a")).collect()
    once = {i: t for i, t, _ in ODD if i not in (6, None)}
    check(rows, once)
    assert sum(r.doc_id == 6 for r in rows) == 2
    assert sum(r.length for r in rows if r.doc_id == 2) == 1
    assert op10_best_fit_packing(spark, store(documents(spark, []), tmp_path / "b")).count() == 0


def test_ids_come_along_when_asked_for(spark):
    df = documents(spark, [(1, "hello world", "x")]).withColumnRenamed("lang", "offset")
    row = pack_documents(df, with_ids=True, window=2).orderBy("start").collect()
    got = np.concatenate([np.frombuffer(r.ids, "<u4") for r in row]).tolist()
    assert got == PLAIN.encode("hello world", add_special_tokens=False).ids + [1]

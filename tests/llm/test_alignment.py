from __future__ import annotations

import hashlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import ODD, documents, store
from touchline.llm import alignment
from touchline.llm.alignment import (
    Csr,
    GroupTexts,
    align,
    align_texts,
    byte_level,
    default_tokenizers,
    op11_token_alignment,
    product,
    score_links,
    sentence_pieces,
    shared_group_links,
    token_bytes,
    transposed,
)

PATHS = default_tokenizers()
TEXTS = ["", "a", " two  spaces", "don't <|endoftext|> </s><0x41>", "naïve ▁ text", "語 € \U0001f600́x", "a\n\tb\x00c  ", "ﬁ"]


@cache
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, SentencePieceProcessor(model_file=PATHS[1])


def decoded(entry: str) -> bytes:
    """A byte-level entry as bytes, by the published rule: letters above 255 are the unprintable bytes in order."""
    own = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    rest = [b for b in range(256) if b not in own]
    return bytes(ord(c) if ord(c) < 256 else rest[ord(c) - 256] for c in entry)


def tokens(text: str) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]]:
    """Ids and bytes on both sides; none if the bytes aren't the text's."""
    first, second = tokenizers()
    a = [(i, decoded(first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        byte = len(piece) == 6 and piece.startswith("<0x") and second.is_byte(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    same = all(b"".join(x for _, x in side) == whole for side in (a, b))
    return (a, b) if text and same else ([], [])


def spans(side):
    at, out = 0, []
    for i, piece in side:
        out.append((i, at, at + len(piece)))
        at += len(piece)
    return out


def brute(texts: list[str | None]) -> list[tuple]:
    """By all pairs of tokens of a text."""
    made, holding = [], Counter()
    for text in texts:
        a, b = map(spans, tokens(text or ""))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [
            tuple([x[0] for x in side if low < x[2] <= high] for side in (a, b)) for low, high in zip([0, *cuts], cuts)
        ]
        made.append((len(a), len(b), groups, links))
        holding.update(set(links))
    most: dict[int, int] = {}
    for (a, _), n in holding.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for n_a, n_b, groups, links in made:
        text = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        out.append(
            (
                n_a,
                n_b,
                len(groups),
                len(links),
                sum(len(x) * len(y) for x, y in groups),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
                sum(holding[p] == most[p[0]] for p in links),
                sum(holding[p] for p in links),
            )
        )
    return out


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "n_best", "count_sum")


def dense(a: Csr) -> np.ndarray:
    out = np.zeros((a.rows, a.columns), np.int64)
    for row in range(a.rows):
        for at in range(a.indptr[row], a.indptr[row + 1]):
            out[row, a.indices[at]] += a.data[at]
    return out


def sparse(m: np.ndarray) -> Csr:
    row, column = np.nonzero(m)
    return Csr(np.searchsorted(row, np.arange(len(m) + 1)), column, m[row, column], m.shape[1])


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 5), st.integers(1, 6), st.integers(1, 5), st.integers(0, 2**32 - 1))
def test_products_are_those_of_dense_matrices(n, k, m, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-1, 2, (n, k)) * rng.integers(0, 4, (n, k)), rng.integers(0, 3, (k, m))
    assert (dense(product(sparse(a), sparse(b))) == a @ b).all()
    assert (dense(transposed(sparse(b))) == b.T).all()
    low = n // 2
    assert (dense(product(sparse(a), sparse(b), low, n)) == (a @ b)[low:]).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Ee'sé語▁\n\t<0x41>|\U0001f600"), max_size=20), min_size=1, max_size=4))
def test_links_and_groups_match_all_pairs(texts):
    first, second = byte_level(PATHS[0]), sentence_pieces(PATHS[1])
    it = align(texts, first, second)
    got = {}
    for row, column, common in it.links():
        got |= {(int(i), int(j)): int(c) for i, j, c in zip(row, column, common)}
    want, at_a, at_b, names = {}, 0, 0, []
    for text in texts:
        a, b = map(spans, tokens(text))
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                if (over := min(x[2], y[2]) - max(x[1], y[1])) > 0:
                    want[at_a + i, at_b + j] = over
        at_a, at_b = at_a + len(a), at_b + len(b)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        part = lambda side, low, high: ",".join(str(x[0]) for x in side if low < x[2] <= high)
        names.append(";".join(f"{part(a, *c)}|{part(b, *c)}" for c in zip([0, *cuts], cuts)).encode())
    assert got == want
    assert GroupTexts(first, second).of(it) == names


@pytest.mark.parametrize("hot", [0, 40, 10**6])
def test_rows_match_all_pairs(spark, hot):
    texts = TEXTS + [None, "don't", "a", "the same text twice", "the same text twice", "twice the text " * 40]
    df = documents(spark, [(n, t, "x") for n, t in enumerate(texts)]).repartition(3)
    rows = {r.doc_id: r for r in score_links(align_texts(df), hot).collect()}
    assert [tuple(rows[n][c] for c in FIGURES) for n in range(len(texts))] == brute(texts)


def test_long_texts_go_in_blocks(spark, monkeypatch):
    text = "naïve words of 語 length " * 60
    want = brute([text])[0]
    monkeypatch.setattr(alignment._blocks, "__defaults__", (7,))
    first, second = byte_level(PATHS[0]), sentence_pieces(PATHS[1])
    columns = alignment._measured(
        align(["", text], first, second), GroupTexts(first, second), (len(first.pieces), len(second.pieces))
    )
    assert [c[1].as_py() for c in columns[:6]] == list(want[:6])
    assert sum(columns[8][1].as_py()) == want[3]
    assert pa.types.is_list(columns[6].type)


def test_shared_group_links(spark):
    text = "don't align naïve 語"
    rows = shared_group_links(documents(spark, [(1, None, "x"), (4, text, "x")])).collect()
    a, b = map(spans, tokens(text))
    cuts = sorted({x[2] for x in a} & {y[2] for y in b})
    group = lambda end: next(k for k, c in enumerate(cuts) if end <= c)
    want = {(4, i, j, x[0], y[0]) for i, x in enumerate(a) for j, y in enumerate(b) if group(x[2]) == group(y[2])}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)


def test_odd_rows(spark, tmp_path):
    df = documents(spark, ODD)
    rows = op11_token_alignment(spark, store(df, tmp_path / "a")).collect()
    long = ODD[8][1]
    short = [t for _, t, _ in ODD if t != long]
    want = Counter((i, *f[:6]) for (i, t, _), f in zip([r for r in ODD if r[1] != long], brute(short)))
    got = Counter(tuple(r[c] for c in ("doc_id", *FIGURES[:6])) for r in rows if r.doc_id != 8)
    assert got == want and len(rows) == len(ODD)
    assert next(r for r in rows if r.doc_id == 8).n_links >= 30_000
    assert op11_token_alignment(spark, store(documents(spark, []), tmp_path / "b")).collect() == []
    clashing = df.withColumnRenamed("lang", "a").withColumnRenamed("n_chars", "_at").withColumn("links", F.lit(1))
    assert score_links(align_texts(clashing)).count() == len(ODD)


def test_bytes_of_all_ids():
    first, second = tokenizers()
    known = byte_level(PATHS[0]), sentence_pieces(PATHS[1])
    special = first.token_to_id("<|endoftext|>")
    for i in range(first.get_vocab_size()):
        assert i == special or known[0].pieces[i] == decoded(first.id_to_token(i))
    assert len(known[1].pieces) == second.get_piece_size()
    assert (token_bytes(np.array([2, 3])).indptr == [0, 2, 3]).all()

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import ODD, documents, store
from touchline.llm.tokens import Encoder, allocate, attribute_tokens, default_ranks, op4_offset_attribution, sections

KNOWN = Encoder(default_ranks())


def brute(text_parts, rule):
    """Token by token: the bytes it covers, each in one section."""
    owner = [i for i, p in enumerate(text_parts) for _ in p.encode()]
    counts, crossing, at = [0.0] * len(text_parts), [0] * len(text_parts), 0
    for token in KNOWN.encoding.encode_ordinary("".join(text_parts)):
        size = len(KNOWN.encoding.decode_single_token_bytes(token))
        covered = owner[at : at + size]
        at += size
        if rule == "start":
            counts[covered[0]] += 1
        elif rule == "end":
            counts[covered[-1]] += 1
        else:
            for i in covered:
                counts[i] += 1 / size
        crossing[covered[0]] += covered[0] != covered[-1]
    assert at == len(owner)
    return counts, crossing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n.é語", max_size=12), min_size=1, max_size=5), st.sampled_from(["start", "end", "share"]))
def test_allocation_by_brute_force(parts, rule):
    ends = KNOWN.ends("".join(parts))
    borders = np.cumsum([len(p.encode()) for p in parts])
    counts, crossing = allocate(ends, borders, rule)
    want, over = brute(parts, rule)
    assert np.allclose(counts, want) and crossing.tolist() == over
    assert abs(counts.sum() - len(ends)) < 1e-9


def test_fields_of_a_record(spark):
    df = spark.createDataFrame([(1, "user", "hello world"), (2, None, None)], "n_tokens long, role string, text string")
    parts = F.array("role", F.lit(": "), "text")
    rows = attribute_tokens(df, ["n_tokens"], parts.alias("x"), "share").drop("n_tokens").collect()
    assert len(rows) == 6
    with pytest.raises(ValueError):
        attribute_tokens(df, [], parts, "middle")


def test_query_by_brute_force(spark, tmp_path):
    rows = op4_offset_attribution(spark, store(documents(spark, ODD), tmp_path / "a")).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    for i, text, _ in ODD:
        if i == 6:
            continue
        own = sorted(got[i], key=lambda r: r.section)
        parts = [p for p in (text or "").splitlines(keepends=True)] if "\x85" not in (text or "") else None
        counts, crossing = brute(parts or [""], "start")
        assert [r.n_tokens for r in own] == counts and [r.n_crossing for r in own] == crossing
        assert all(r.doc_tokens == sum(counts) for r in own)
    assert len(got[6]) == 2
    assert op4_offset_attribution(spark, store(documents(spark, []), tmp_path / "b")).count() == 0


def test_sections_make_up_the_text(spark):
    texts = ["", "a", "a\n", "\n\n", "a\nb\n\nc", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", sections(F.col("text")).alias("s"))
    for r in df.collect():
        assert "".join(r.s) == (r.text or "") and r.s
        assert all(x.endswith("\n") for x in r.s[:-1])

"""Pairs at the limit: none is lost to a low estimate, and the stage's limit is its own."""

from __future__ import annotations

import numpy as np
import pytest

from cases import documents
from test_near_duplicates import pair, shingle_set
from touchline.llm.near_duplicates import (
    LINK_PERCENT,
    STAGE_PERCENT,
    band_miss,
    bands_of,
    block_links,
    group,
    least_estimate,
    registers,
    without_near_duplicates,
)


@pytest.mark.parametrize("seed", [335, 674, 1849, 1912])
def test_pairs_at_the_limit_are_verified_whatever_their_estimate(seed):
    a, b = map(np.sort, pair(185, 170, seed))  # 170 of 200 are common, yet 112 to 118 of 156 registers are equal
    assert block_links([1, 2], [a, b], np.stack([registers(a), registers(b)]), None) == [(1, 2)]


def test_estimates_lose_no_more_than_bands():
    assert least_estimate(LINK_PERCENT) == pytest.approx(0.70)
    assert band_miss(LINK_PERCENT) < 5e-6


def test_bands_follow_from_the_limit():
    assert bands_of(LINK_PERCENT) == (26, 6) and bands_of(STAGE_PERCENT) == (31, 5)
    assert all(band_miss(limit) < 5e-6 for limit in (50, 60, 70, 80, 85, 90, 99))
    assert least_estimate(STAGE_PERCENT) < 0.66


def components(rows, limit):
    """Smallest ids of the groups by comparing every pair (ids ascend)."""
    sets, part = [shingle_set(t) for _, t, _ in rows], {i: i for i, _, _ in rows}
    for x, (i, _, _) in enumerate(rows):
        for y, (k, _, _) in enumerate(rows[:x]):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= limit * len(sets[x] | sets[y]):
                old, new = max(part[i], part[k]), min(part[i], part[k])
                part = {n: new if c == old else c for n, c in part.items()}
    return part


def test_the_stage_links_at_80(spark):
    rows = []
    for n in range(40):  # 118 to 126 words, the last 9 to 13 of them others in the copy: 80 to 86 of 100 at most
        words = [f"w{n}x{k}" for k in range(118 + n % 9)]
        changed = 9 + n % 5
        rows += [(10 * n, " ".join(words), "x"), (10 * n + 1, " ".join(words[:-changed] + [f"y{n}x{k}" for k in range(changed)]), "x")]
    df = documents(spark, rows)
    at = {limit: components(rows, limit) for limit in (80, 85)}
    assert len(set(at[80].values())) < len(set(at[85].values())) - 10
    assert {r.doc_id for r in without_near_duplicates(df).collect()} == set(at[80].values())
    for limit in (80, 85):
        assert {r.doc_id: r.component_id for r in group(df, limit=limit).collect()} == at[limit]

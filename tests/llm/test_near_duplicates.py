from __future__ import annotations

import random
import re

import numpy as np
import pytest

from cases import ODD, documents, store
from touchline.llm.components import connected_components
from touchline.llm import near_duplicates
from touchline.llm.near_duplicates import (
    REGISTERS,
    block_links,
    cells,
    group,
    merge,
    op3_setsketch_near_duplicates,
    registers,
    shingles,
    similarity,
    without_near_duplicates,
)
from touchline.llm.words import WordHashes


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, limit=85):
    """(doc_id, n_shingles, component_id, kept) by comparing every pair."""
    sets = [shingle_set(t) for _, t, _ in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= limit * len(sets[x] | sets[y]):
                part[root(x)] = root(y)
    ids = {}
    for x, (i, _, _) in enumerate(rows):
        ids.setdefault(root(x), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return sorted(
        ((i, len(sets[x]), least[root(x)], i == least[root(x)]) for x, (i, _, _) in enumerate(rows)), key=str
    )


def family(rng, at, n, words=120, most=12):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for k in range(n):
        copy = list(base)
        for _ in range(rng.randrange(most) if k else 0):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append((at + k, " ".join(copy), "x"))
    return out


@pytest.mark.parametrize("block", [5, 128])
def test_groups_match_brute_force(spark, block):
    rng = random.Random(7)
    rows = family(rng, 0, 60) + family(rng, 100, 3, most=2) + family(rng, 200, 40, words=30, most=3)
    rows += [(300 + k, f"alone {k} " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(50)), "x") for k in range(30)]
    rows += [(400, "", "x"), (401, None, "x"), (402, " \n", "x"), (403, "Two words", "x"), (404, "two  WORDS", "x")]
    rows += [(405, rows[3][1].upper(), "y"), (406, rows[3][1], "y"), (407, rows[3][1], "y")]
    rng.shuffle(rows)
    got = group(documents(spark, rows).repartition(4), block=block).drop("text_key").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_odd_rows(spark, tmp_path):
    got = op3_setsketch_near_duplicates(spark, store(documents(spark, ODD), tmp_path / "a")).collect()
    assert sorted(map(tuple, got), key=str) == brute(ODD)
    assert op3_setsketch_near_duplicates(spark, store(documents(spark, []), tmp_path / "b")).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d e f", "x"), (2, "A b c d e f", "x"), (9, "other words here now", "x"), (1, "", "x"), (3, "", "x")]
    df = documents(spark, rows).withColumnRenamed("lang", "node").withColumnRenamed("n_chars", "kept")
    left = without_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 9]


def test_columns_of_any_name_may_be_there(spark):
    rows = [(5, "a b c d e f", "x"), (2, "A b c d e f", "x"), (3, None, "x")]
    df = documents(spark, rows).withColumnRenamed("lang", "_id").withColumnRenamed("n_chars", "_key")
    df = df.withColumnRenamed("source", "row").withColumn("text_key", df["doc_id"])
    left = without_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3]


def pair(n, common, seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
    return pool[:n], pool[n - common :]


def test_sketches_estimate_and_merge():
    for n, common in ((1000, 920), (500, 300), (3000, 0), (40, 39)):
        estimates = []
        for seed in range(12):
            a, b = pair(n, common, seed)
            x, y = registers(a), registers(b)
            assert (merge(x, y) == registers(np.union1d(a, b))).all()
            counts = [np.array([(x > y).sum()]), np.array([(x < y).sum()])]
            estimates.append(similarity(*counts, np.array([float(n)]), np.array([float(n)]))[0])
        assert abs(np.mean(estimates) - common / (2 * n - common)) < 0.04
    assert (registers(np.empty(0, np.uint64)) == 0).all() and len(registers(a)) == REGISTERS


def test_a_block_hands_on_no_more_than_a_tree():
    hashes = WordHashes()
    base = " ".join(f"w{i}" for i in range(300))
    sets = [shingles(f"{base} end{k}", hashes) for k in range(50)]
    links = block_links(list(range(50)), sets, np.stack([registers(s) for s in sets]), None)
    assert len(links) == 49


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))
    assert got[201] == got[200] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def counted(monkeypatch):
    """Rows of text that meet, and links that are handed on, while groups are found."""
    seen = {"texts": 0, "links": 0}
    beside, stars = near_duplicates._beside, near_duplicates.star_links

    def count_texts(rows, texts):
        seen["texts"] += rows.count()
        return beside(rows, texts)

    def count_links(pairs, texts, limit):
        found = stars(pairs, texts, limit)
        seen["links"] += found.count()
        return found

    monkeypatch.setattr(near_duplicates, "_beside", count_texts)
    monkeypatch.setattr(near_duplicates, "star_links", count_links)
    return seen


def test_a_family_costs_a_few_texts_and_links_a_document(spark, monkeypatch):
    rng = random.Random(3)
    rows = family(rng, 0, 1500, words=300, most=4)
    seen = counted(monkeypatch)
    got = group(documents(spark, rows).repartition(4)).collect()
    assert {r.component_id for r in got} == {0}
    assert seen["texts"] < 5 * 1500 and seen["links"] < 3 * 1500


def test_families_that_share_bands_are_told_apart(spark):
    """Families around one text that they all come near to, without linking to each other."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for n in range(6):
        own = list(base)
        own[10 * n : 10 * n + 40] = [f"y{n}x{k}" for k in range(40)]
        for k in range(12):
            copy = list(own)
            copy[rng.randrange(200)] = f"z{n}x{k}"
            rows.append((100 * n + k, " ".join(copy), "x"))
    got = group(documents(spark, rows).repartition(3), block=7).drop("text_key").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_cells_hold_what_is_not_connected_with_its_hub(spark):
    nodes = [(1, i, 1, 1, 10) for i in range(1, 41)] + [(1, i, i, 1, 10) for i in range(41, 51)]
    nodes += [(60, i, 60, 60, 10) for i in range(60, 90)]  # all connected: no cell
    df = spark.createDataFrame(nodes, "hub long, id long, part long, hub_part long, n_bytes long")
    for block, block_bytes in ((8, 10**6), (1000, 90), (1000, 10**6)):
        met = {}
        for r in cells(df, block, block_bytes).collect():
            met.setdefault((r.hub, r.lo, r.hi), []).append((r.id, r.block))
        pairs = set()
        for (hub, lo, hi), members in met.items():
            assert hub == 1 and {b for _, b in members} <= {lo, hi}
            pairs |= {(a, b) for a, x in members for b, y in members if a < b and (x != y or lo == hi)}
        assert pairs >= {(a, b) for a in range(1, 51) for b in range(41, 51) if a < b}
        assert not any(a <= 40 and b <= 40 for a, b in pairs)


def test_repeated_rows_and_rows_without_id(spark):
    rng = random.Random(4)
    rows = family(rng, 0, 8) + [(None, family(rng, 0, 1)[0][1], "x")] * 3
    rows += [rows[2]] * 200 + [(None, rows[3][1], "x")] * 2
    got = group(documents(spark, rows).repartition(5)).drop("text_key").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)

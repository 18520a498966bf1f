from __future__ import annotations

import re
from collections import Counter

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ODD, documents, store
from helpers import plan
from touchline.llm.lines import _measure, judge, line_frequencies, measure_texts, op5_line_frequency, without_frequent_lines
from touchline.llm.words import WordHashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def verdicts(rows, limit):
    """The rule by brute force: (doc_id, text, host) to the list of kept flags by row."""
    norm = lambda x: " ".join(re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(x))
    documents_of = {}
    for at, (i, t, s) in enumerate(rows):
        for line in {norm(x) for x in (t or "").split("\n")} - {""}:
            documents_of.setdefault((s, line), set()).add(f"row {at}" if i is None else i)
    out = Counter()
    for i, t, s in rows:
        text = t or ""
        words, *_, repeat = base(text)
        gone = sum(
            len(WORD.findall(x)) for x in text.split("\n") if len(documents_of.get((s, norm(x)), ())) > limit
        )
        failed = words < 50 or 100 * repeat > 50 * words
        out[i, failed, gone, not failed and 100 * gone <= 50 * words] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab A#<\n\t\x0b\x1c\x85é ", max_size=60))
def test_base_figures(text):
    assert _measure(text, WordHashes())[0] == base(text)


def corpus():
    body = lambda n, k: " ".join(f"w{n}x{j}" for j in range(k))
    rows = [(n, f"{body(n, 60)}\nHome  About\n{'menu ' * 5}", "a") for n in range(5)]
    rows += [(10 + n, f"{body(n + 10, 55)}\n" + "\n".join(f"Shared line {k} of this host" for k in range(20)), "a") for n in range(5)]
    rows += [(20 + n, f"{body(n + 20, 60)}\nhome about", "b") for n in range(3)]
    rows += [(30, rows[5][1], "a"), (31, rows[5][1], "a"), (31, rows[5][1], "a")]
    return rows + ODD


@pytest.mark.parametrize("limit", [2, 4, 5, 50])
def test_verdict_matches_brute_force(spark, limit):
    rows = corpus()
    got = judge(documents(spark, rows).repartition(3), max_documents=limit).collect()
    assert Counter((r.doc_id, r.base_failed, r.removed_words, r.kept) for r in got) == verdicts(rows, limit)


def test_documents_are_counted_by_id(spark):
    rows = [(n, "one line", "a") for n in range(9)]  # copies under different ids
    rows += [(10, "One  LINE\nmore", "a"), (10, "more\nand one", "a"), (10, "one line", "a"), (10, "one line", "b")]
    rows += [(None, "and one", "a")] * 3 + [(None, "one line", None)] * 2
    counts = {(r.host, bytes(r.line)): r.documents for r in line_frequencies(measure_texts(documents(spark, rows))).collect()}
    line = lambda x: xxhash.xxh3_128_digest(x.encode())
    assert counts == {
        ("a", line("one line")): 10,
        ("a", line("more")): 1,
        ("a", line("and one")): 4,
        ("b", line("one line")): 1,
        (None, line("one line")): 2,
    }


def test_copies_of_a_text_deplete_each_other(spark):
    text = " ".join(f"w{j}" for j in range(80))
    rows = [(n, text, "a") for n in range(200)] + [(n, text, "b") for n in range(200, 250)]
    rows += [(900, text + " in c", "c")] * 200
    got = judge(documents(spark, rows).repartition(3)).collect()
    assert Counter((r.removed_words, r.kept) for r in got) == {(80, False): 200, (0, True): 250}


def test_a_hot_line_leaves_a_task_once(spark):
    df = documents(spark, [(n, "the same line", "a") for n in range(4000)]).repartition(4)
    found = line_frequencies(measure_texts(df))
    assert [r.documents for r in found.collect()] == [4000]
    plan_text = plan(found)
    assert "partial_count(1)" in plan_text and "partial_sum" in plan_text


def test_frequent_lines_are_cut_out(spark):
    df = documents(spark, [(1, "a\nTop", "x"), (2, "b\ntop", "x"), (3, "c\n top ", "x"), (4, "top", "y"), (5, None, "x")])
    got = {r.doc_id: r.text for r in without_frequent_lines(df, max_documents=2).collect()}
    assert got == {1: "a", 2: "b", 3: "c", 4: "top", 5: None}


def test_clashing_columns_and_empty_table(spark, tmp_path):
    df = documents(spark, ODD).withColumnRenamed("lang", "digest").withColumnRenamed("n_chars", "host")
    assert judge(df).count() == len(ODD)
    assert without_frequent_lines(df).columns == df.columns
    assert op5_line_frequency(spark, store(documents(spark, []), tmp_path)).count() == 0

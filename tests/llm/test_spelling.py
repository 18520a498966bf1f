from __future__ import annotations

import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ODD, documents, store
from touchline.llm.spelling import MARK, met, op13_permuterm_variants, rotations, variants, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(run: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), run)


def counts(rows, divisor=199, shortest=6, least=5) -> dict[str, int]:
    found: Counter[str] = Counter()
    for key, text, *_ in rows:
        for run in map(lowered, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % divisor == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= least}


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words: dict[str, int], ratio=5) -> dict[str, tuple]:
    near = {a: [b for b in words if one_apart(a, b)] for a in words}
    best = {a: min(bs, key=lambda b: (-words[b], b), default=None) for a, bs in near.items()}
    form = {a: b if b is not None and words[b] >= ratio * words[a] else None for a, b in best.items()}

    def root(a):
        return a if form[a] is None else root(form[a])

    return {a: (form[a], root(a), n, len(near[a]), words.get(form[a])) for a, n in words.items()}


def result(df) -> dict[str, tuple]:
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=1, max_size=5), st.integers(1, 40), max_size=25))
def test_groups_meet_every_near_word_once(words):
    groups: dict[str, list] = {}
    for word, n in words.items():
        marked = word + MARK
        for at in range(len(marked)):
            groups.setdefault(marked[at:] + marked[:at], []).append(("", False, n))
        for at in range(len(word)):
            first = at == 0 or word[at] != word[at - 1]
            groups.setdefault(marked[at + 1 :] + marked[:at], []).append((word[at], first, n))
    near, best = Counter(), {}
    for prefix, members in groups.items():
        for word, count, n, other in met(prefix, members):
            near[word] += count
            best[word] = min(best.get(word, (1, "")), (-n, other))
    want = brute(words)
    assert {w: near[w] for w in words} == {w: v[3] for w, v in want.items()}
    for word, (n, other) in best.items():
        assert (n, other) == min((-words[b], b) for b in words if one_apart(word, b))


def test_rotations_are_all_there(spark):
    df = spark.createDataFrame([("aab", 7)], "word string, n long")
    got = sorted((r.prefix.replace(MARK, "$"), r.edited, r.first, r.n) for r in rotations(df).collect())
    assert got == sorted(
        [(p, "", False, 7) for p in ("aab$", "ab$a", "b$aa", "$aab")]
        + [("ab$", "a", True, 7), ("b$a", "a", False, 7), ("$aa", "b", True, 7)]
    )


def test_variants_match_brute_force(spark):
    words = {"colour": 50, "color": 400, "colouur": 9, "coloor": 2, "colors": 3, "ççççé": 1, "çççç": 5, "çççé": 4}
    words |= {"tieaaa": 5, "tieaab": 30, "tieaac": 30, "a": 1, "b": 60, "ab": 300, "": 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert result(variants(df)) == brute(words)


def test_one_hot_place_with_all_letters(spark):
    """A group holds a word for each letter, however often the words occur; copies of a row count."""
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    words = {f"some{c}thing": 5 + 7 * k for k, c in enumerate(letters)} | {"something": 3_000_000}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(variants(df)) == brute(words)


def test_counts_of_odd_rows(spark, tmp_path):
    rows = ODD + [(n, "Größe GRÖßE größe× naïveté naïvete " * 3, "x") for n in range(20, 60)]
    rows += [(n, "notable notible " * 8 + "nótable", None) for n in range(60, 320)]
    df = documents(spark, rows).withColumnRenamed("lang", "word").withColumnRenamed("n_chars", "n")
    assert {r.word: r.n for r in word_counts(df).collect()} == counts(rows)
    assert result(op13_permuterm_variants(spark, store(documents(spark, rows), tmp_path))) == brute(counts(rows))


def test_damage_is_by_document_and_run(spark):
    rows = [(n, "variants of words", "x") for n in range(400)] + [(None, "variants", "x")] * 5
    got = {r.word: r.n for r in word_counts(documents(spark, rows), min_count=1).collect()}
    assert got == counts(rows, least=1) and len(got) > 1


def test_empty_table(spark, tmp_path):
    assert op13_permuterm_variants(spark, store(documents(spark, []), tmp_path)).collect() == []

from __future__ import annotations

import textwrap
from pathlib import Path

import pytest

from cases import ODD, documents, store
from compare import connect, differences
from touchline.llm.licences import NOTICES, find_licences, known_digests, op7_licence_digests, scan
from touchline.llm.oracles import ORACLES

MIT = next(text for name, text in NOTICES if name == "MIT" and len(text) > 100)


def rows(spark, *texts):
    return documents(spark, [(i, t, "x") for i, t in enumerate(texts)])


def test_equivalent_forms_are_the_same(spark):
    df = rows(
        spark,
        "Copyright (c) 1999 Somebody\n\n" + MIT,
        "© 2001 A. Nother, Ltd.\nAll rights reserved.\n\n  " + MIT.upper().replace("\n\n", "\n \n"),
        MIT.replace('"', "'").replace("Software", "software").replace("sublicense", "sub-license"),
    )
    assert [(r.licenses, r.whole) for r in scan(df, known_digests(spark)).collect()] == [("MIT", True)] * 3


def test_other_texts_are_not(spark):
    df = rows(spark, MIT[:-20], MIT + " Unless it rains.", "I read the MIT License.", "", None)
    assert all(r.licenses == "" and r.n_lines == 0 and not r.whole for r in scan(df, known_digests(spark)).collect())


def test_lines_and_paragraphs(spark):
    df = rows(spark, f"Some words.\nreleased under the MIT licence\n\n{MIT}\n\nLicensed under CC-BY-NC 4.0!")
    found = {(r.kind, r.license) for r in find_licences(df, known_digests(spark), ["doc_id"]).collect()}
    assert found == {("line", "MIT"), ("line", "CC-BY-NC-4.0"), ("paragraph", "CC-BY-NC-4.0"), ("paragraph", "MIT")}
    assert scan(df, known_digests(spark)).head().licenses == "CC-BY-NC-4.0,MIT"


def test_clashing_names_and_custom_texts(spark):
    df = rows(spark, "My Own Terms", "other").withColumnRenamed("lang", "license").withColumnRenamed("n_chars", "digest")
    known = known_digests(spark, [("own", "my own terms.")])
    assert [r.licenses for r in scan(df, known).orderBy("doc_id").collect()] == ["own", ""]


def test_odd_rows_match_sql(spark, tmp_path):
    extra = [(20, "Released under the MIT License.", "x"), (20, "Released under the MIT License.", "x"), (20, "no", "x"),
             (None, "a\nReleased under the\tMIT License\nLicensed under the Apache License, Version 2.0.", "x")]
    sf = store(documents(spark, ODD + extra).coalesce(1), tmp_path / "sf")
    con = connect(sf)
    con.execute(f"create or replace view documents as select * from '{sf}/documents.parquet/*.parquet'")
    assert differences(op7_licence_digests(spark, sf), con, ORACLES["op7_licence_digests"]) == []
    assert op7_licence_digests(spark, store(documents(spark, []), tmp_path / "none")).count() == 0


WHOLE = [(name, text) for name, text in NOTICES if len(text) > 200]
PUBLISHED = Path("/usr/share/common-licenses")  # where the system has them


@pytest.mark.parametrize("name, text", WHOLE, ids=[f"{n}-{i}" for i, (n, _) in enumerate(WHOLE)])
def test_entire_texts_are_found_bare_titled_and_inside(spark, name, text):
    wrapped = "\n\n".join(textwrap.fill(p, 60, break_on_hyphens=False).replace("\n", "\r\n  ") for p in text.split("\n\n"))
    df = rows(
        spark,
        text,
        f"{name} License\n\nCopyright (c) 2020 Somebody\n\n{wrapped}\n",
        f"About this work.\n\nIt is free:\n\n{text}\n\nSee also the manual.",
        text.replace("\n\n", "\n\nNot at all.\n\n", 1),
    )
    got = scan(df, known_digests(spark)).orderBy("doc_id").collect()
    assert [(r.licenses, r.whole) for r in got[:3]] == [(name, True), (name, False), (name, False)]
    assert got[3].licenses == ""


def test_long_texts_as_published(spark):
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    texts = {name: (PUBLISHED / file).read_text(encoding="utf-8") for name, file in files.items() if (PUBLISHED / file).exists()}
    if not texts:
        pytest.skip("no published texts on this system")
    for name, text in texts.items():
        df = rows(spark, text, f"COPYING\n\n{text}\n\nThe end of this file.", text[: len(text) // 2])
        got = scan(df, known_digests(spark)).orderBy("doc_id").collect()
        assert [(r.licenses, r.whole) for r in got] == [(name, True), (name, False), ("", False)]


def test_runs_are_found_wherever_they_begin(spark):
    known = known_digests(spark, [("two", "one\n\ntwo"), ("three", "one\n\ntwo\n\nthree"), ("again", "one\n\none")], [])
    df = rows(spark, "zero\n\none\n \n\nTwo!\n\nthree", "one\n\none\n\ntwo", "one", "two\n\none", "one\ntwo")
    got = [r.licenses for r in scan(df, known).orderBy("doc_id").collect()]
    assert got == ["three,two", "again,two", "", "", "two"]

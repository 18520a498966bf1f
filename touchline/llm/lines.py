"""Quality rules: what a text says about itself, and how often its lines occur on the same host.

A line that many documents of one host share is a menu, a footer or a notice. Lines are normalised and
hashed, their documents counted per host, lines above the limit count as removed, and a document that
loses most of its words that way is rejected. A document is a doc_id: copies of a text under different
ids count one by one, a row repeated with its id counts once, and a row without id counts for itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import SPACES, table
from touchline.llm.words import WordHashes, window_hashes
from touchline.session import materialise

MAX_DOCUMENTS = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_REMOVED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def normalised_line(line: bytes) -> bytes:
    """A-Z lower-cased, white space single: what makes two lines the same line."""
    return b" ".join(line.lower().split())


def repeat_words(hashes: np.ndarray) -> int:
    """Words within three-word windows that occur at least twice in the text."""
    windows = window_hashes(hashes, 3)
    if len(windows) < 2:
        return 0
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    within = np.zeros(len(hashes), bool)
    for shift in range(3):
        within[starts + shift] = True
    return int(within.sum())


def _measure(text: str, hashes: WordHashes) -> tuple[tuple[int, ...], dict[bytes, int]]:
    """The base figures of a text, and per normalised line the words it has in all."""
    raw = text.encode()
    words = raw.split()
    seen: Counter[bytes] = Counter()
    by_line: Counter[bytes] = Counter()
    for line in raw.split(b"\n"):
        if parts := line.lower().split():
            seen[line] += 1
            by_line[xxhash.xxh3_128_digest(b" ".join(parts))] += len(parts)
    base = (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        sum(seen.values()) - len(seen),
        repeat_words(hashes.of(words)),
    )
    return base, by_line


_MEASURED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("host", pa.string()),
        ("digest", pa.binary()),
        *[(name, pa.int64()) for name in _BASE],
        ("lines", pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())]))),
    ]
)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        rows = {name: [] for name in _MEASURED.names}
        rows["doc_id"], rows["host"] = batch.column("doc_id"), batch.column("host")
        for value in batch.column("text"):
            text = value.as_py() or ""
            base, by_line = _measure(text, hashes)
            rows["digest"].append(xxhash.xxh3_128_digest(text.encode()))
            for name, figure in zip(_BASE, base):
                rows[name].append(figure)
            rows["lines"].append([{"line": k, "words": v} for k, v in by_line.items()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[f.name], f.type) if isinstance(rows[f.name], list) else rows[f.name] for f in _MEASURED],
            schema=_MEASURED,
        )


def measure_texts(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Base figures and line digests of every row, in one pass and without a shuffle.

    A null text counts as an empty one: all figures 0, no lines. A long text is measured whole, alone in its
    task: some 80 bytes of memory for each of its words, and 100 for each different line.
    """
    given = df.select(
        F.col(key).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text")
    )
    counts = ", ".join(f"{name} long" for name in _BASE)
    return given.mapInArrow(
        _measured,
        f"doc_id long, host string, digest binary, {counts}, lines array<struct<line: binary, words: long>>",
    )


def line_frequencies(measured: DataFrame) -> DataFrame:
    """Documents per host and line; one row per pair. Rows without host are a host.

    Lines of ids that have one row on their host, nearly all, are summed in the map task, so a line of
    many documents leaves a task once. Only ids with several rows there are counted as different ids.
    """
    several = measured.where("doc_id is not null").groupBy("host", "doc_id").agg(F.count("*").alias("n")).where("n > 1")
    # Written out, so that the joins are planned by its true size.
    several = materialise(several.select(F.col("host").alias("_host"), F.col("doc_id").alias("_id")), "repeated-ids")
    same = F.col("host").eqNullSafe(F.col("_host")) & (F.col("doc_id") == F.col("_id"))

    def counts(how: str, documents) -> DataFrame:
        lines = measured.join(several, same, how).select("host", "doc_id", F.explode("lines.line").alias("line"))
        return lines.groupBy("host", "line").agg(documents.alias("documents"))

    both = counts("left_anti", F.count("*")).unionByName(counts("left_semi", F.count_distinct("doc_id")))
    return both.groupBy("host", "line").agg(F.sum("documents").alias("documents"))


def _lines(measured: DataFrame) -> DataFrame:
    """A row per host, text and line. Copies fall together in the map task, before the shuffle."""
    each = measured.select("host", "digest", F.explode("lines").alias("at"))
    return each.groupBy("host", "digest", F.col("at.line").alias("line")).agg(F.first("at.words").alias("words"))


def removed_words(measured: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """Per host and text the words in lines that more than ``max_documents`` documents of the host have.

    The frequent lines are written out, so that the join is planned by their true size.
    """
    frequent = materialise(
        line_frequencies(measured).where(F.col("documents") > max_documents).select(
            F.col("host").alias("_host"), F.col("line").alias("_line")
        ),
        "frequent-lines",
    )
    hit = (F.col("host").eqNullSafe(F.col("_host"))) & (F.col("line") == F.col("_line"))
    return _lines(measured).join(frequent, hit).groupBy("host", "digest").agg(F.sum("words").alias("removed_words"))


def judge(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
) -> DataFrame:
    """Base figures and verdict of every row: ``base_failed``, ``removed_words``, ``kept``.

    Kept is what passes the base rules and loses at most half of its words with the frequent lines.
    Equal texts on one host get the same verdict, repeated rows each their own row. No row, no verdict.
    """
    measured = materialise(measure_texts(df, key, text, host), "line-measures")
    removed = removed_words(measured, max_documents).select(
        F.col("host").alias("_host"), F.col("digest").alias("_digest"), "removed_words"
    )
    same = F.col("host").eqNullSafe(F.col("_host")) & (F.col("digest") == F.col("_digest"))
    words = F.col("n_words")
    failed = (words < MIN_WORDS) | (F.col("n_repeat_words") * 100 > words * MAX_REPEAT_PERCENT)
    depleted = F.col("removed_words") * 100 > words * MAX_REMOVED_PERCENT
    return (
        measured.join(removed, same, "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .select("doc_id", *_BASE, "base_failed", "removed_words", "kept")
    )


def without_frequent_lines(
    df: DataFrame, text: str = "text", host: str = "source", max_documents: int = MAX_DOCUMENTS
) -> DataFrame:
    """``df`` with the frequent lines cut out of its texts; all rows stay, null texts stay null.

    Every row counts as a document here, as no key is given. A row meets only those frequent lines that it
    has itself.
    """
    numbered = df.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_at"))
    placed = materialise(numbered, "line-rows")
    row = placed.select(
        F.col("_at").alias("doc_id"), F.col("_row")[host].alias("source"), F.col("_row")[text].alias("text")
    )
    measured = materialise(measure_texts(row), "line-measures")
    frequent = line_frequencies(measured).where(F.col("documents") > max_documents)
    hits = (
        measured.select("doc_id", "host", F.explode("lines.line").alias("line"))
        .alias("m")
        .join(frequent.alias("f"), F.expr("m.host <=> f.host and m.line = f.line"))
        .groupBy("m.doc_id")
        .agg(F.collect_set("m.line").alias("_drop"))
    )
    cut = placed.join(hits, placed["_at"] == hits["doc_id"], "left").select("_row", "_drop")
    names = [F.col(f"_row.{c}").alias(c) if c != text else F.col("_text").alias(c) for c in df.columns]
    cutter = F.pandas_udf(_cut, "string")
    return cut.withColumn("_text", cutter(F.col(f"_row.{text}"), F.col("_drop"))).select(*names)


def _cut(texts: pd.Series, drops: pd.Series) -> pd.Series:
    def one(text, drop):
        if text is None or drop is None:
            return text
        gone = {bytes(x) for x in drop}
        return "\n".join(
            x for x in text.split("\n") if xxhash.xxh3_128_digest(normalised_line(x.encode())) not in gone
        )

    return pd.Series([one(t, d) for t, d in zip(texts, drops)])


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of all documents, hosts being their sources; see :func:`judge`."""
    return judge(table(spark, sf_dir, "documents"))

"""Spelling variants: words that differ by one character, found by permuterm rotations.

A word is marked with a terminator and written in all its rotations. In sorted order the rotations that
begin alike stand in a row, so an edit becomes a range of one prefix: rotated until the edited
character comes last, a word ``x c y`` reads ``y $ x c``, and the prefix ``y $ x`` is shared by all words
with another character in that place and is the whole rotation of the word without it. Rotations are
shuffled and sorted by that prefix; a scan over the groups tells every word how many near words it met
there and which is the most frequent. A group has at most one word for each character of the alphabet
and one without it, however many words there are, and hands on a row per member, no pairs.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table
from touchline.session import materialise

# A run is lower-cased in A-Z alone.
RUN = "[a-zÀ-ÿ]+"
# Occurrences of which the hash is divisible by this lose a character.
DIVISOR = 199
MIN_LENGTH = 6
MIN_COUNT = 5
# So many times as frequent is a word that its rarer neighbour is a variant of.
RATIO = 5
MARK = "\x00"


def _damaged(doc: Column, run: Column, divisor: int) -> Column:
    """The run, or the run without the code point that its hash with the document's id names."""
    h = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % divisor == 0, cut).otherwise(run)


def word_counts(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    divisor: int = DIVISOR,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` code points with at least ``min_count`` occurrences.

    Null and empty texts have no words. A null key counts as an empty one in the hash. A repeated row
    counts again. Words are summed in the map task before the shuffle.
    """
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    runs = df.select(F.col(key).alias("doc"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.select(_damaged(F.col("doc"), F.col("run"), divisor).alias("word"))
    return (
        words.where(F.length("word") >= min_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, edited, first, n): the rotations of all marked words.

    Whole rotations have ``edited`` empty. The others stand for an edit of their last character, which
    is in ``edited`` and not in ``prefix``; ``first`` says that it begins its run of equal characters, so
    that taking it out is told from taking out its equals. The mark itself is never edited.
    """
    marked, size = F.concat("word", F.lit(MARK)), F.length("word")

    def turned(at: Column, skip: int) -> Column:
        return F.concat(F.substring(marked, at + 1 + skip, size + 1), F.substring(marked, F.lit(1), at))

    def letter(at: Column) -> Column:
        return F.substring(F.col("word"), at + 1, F.lit(1))

    def whole(at: Column) -> Column:
        return F.struct(turned(at, 0).alias("prefix"), F.lit("").alias("edited"), F.lit(False).alias("first"))

    def edited(at: Column) -> Column:
        first = (at == 0) | (letter(at) != letter(at - 1))
        return F.struct(turned(at, 1).alias("prefix"), letter(at).alias("edited"), first.alias("first"))

    places = F.sequence(F.lit(0), size)
    every = F.concat(F.transform(places, whole), F.transform(F.slice(places, F.lit(1), size), edited))
    return words.select(F.inline(every), "n")


def _unturned(prefix: str, letter: str) -> str:
    after, before = prefix.split(MARK)
    return before + letter + after


Member = tuple[str, bool, int]


def met(prefix: str, members: list[Member]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words in this group, occurrences of the most frequent one, that one) for every member.

    Members are (edited, first, n). Two edits of one place are near by replacement; the word without the
    place, if there is one, is near to every edit that begins its run. Members that meet none have no row.
    """
    edits = sorted((-n, _unturned(prefix, letter), first) for letter, first, n in members if letter)
    whole = [(-n, _unturned(prefix, "")) for letter, _, n in members if not letter]
    longer = [(n, word) for n, word, first in edits if first]
    for n, word in whole:
        if longer:
            yield word, len(longer), -longer[0][0], longer[0][1]
    for n, word, first in edits:
        others = [edits[0] if edits[0][1] != word else edits[1]] if len(edits) > 1 else []
        found = [other[:2] for other in others] + (whole if first else [])
        if found:
            best = min(found)
            yield word, len(edits) - 1 + (len(whole) if first else 0), -best[0], best[1]


_MET = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal prefixes in sorted rows; a group that goes on in the next batch waits for it."""
    waiting: pa.Table | None = None

    def groups(rows: pa.Table) -> pa.RecordBatch:
        prefix = rows["prefix"].combine_chunks()
        edges = [0, *(i + 1 for i in pc.indices_nonzero(pc.not_equal(prefix[1:], prefix[:-1])).to_pylist()), len(prefix)]
        found = []
        for low, high in zip(edges, edges[1:]):
            if high - low > 1:
                part = rows.slice(low, high - low)
                members = zip(*(part[c].to_pylist() for c in ("edited", "first", "n")))
                found += met(prefix[low].as_py(), list(members))
        columns = list(zip(*found)) or [()] * len(_MET)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MET)], schema=_MET)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if waiting is not None:
            rows = pa.concat_tables([waiting, rows])
        last = pc.index(rows["prefix"], rows["prefix"][len(rows) - 1]).as_py() if len(rows) else 0
        waiting = rows.slice(last)
        if last:
            yield groups(rows.slice(0, last))
    if waiting is not None and len(waiting):
        yield groups(waiting)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of those different ``words`` (word, n) that have near words.

    ``best`` is the near word with most occurrences, of equals the smallest in code-point order. Words
    must not hold the terminator (a zero character).
    """
    found = (
        rotations(words)
        .repartition("prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(_scan, "word string, near long, best_n long, best string")
    )
    least = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), least.alias("at"))
        .select("word", "n_near", F.col("at.word").alias("best"), (-F.col("at.n")).alias("best_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chains of (word, form) end.

    Every round goes twice as far. A form is several times as frequent as its word, so there are no
    circles, and a few rounds do; each is written out.
    """
    found = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("end"))
        found = materialise(
            found.join(further, "root", "left").select(
                "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        if found.where("moved").isEmpty():
            return found.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``words`` (word, n), each once, with n_near, form, form_n and root.

    The form is the best near word, if it has at least ``ratio`` times as many occurrences, else null.
    The root is where the forms lead, the word itself if it has none. No words, no rows. ``words`` is
    read several times, so it had better be a stored table. ``ratio`` is above 1.
    """
    near = neighbours(words)
    far = F.col("best_n") >= ratio * F.col("n")
    placed = materialise(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(far, F.col("best")).alias("form"),
            F.when(far, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(placed.where("form is not null"))
    return placed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of all documents with its near words, its form and its root.

    See :func:`word_counts` for which words there are, and for null, empty and repeated rows.
    """
    words = materialise(word_counts(table(spark, sf_dir, "documents")), "spelling-words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")

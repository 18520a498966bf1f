"""Alignment of two tokenizers by products of sparse matrices.

Both tokenizers' tokens cover the same bytes. A matrix of tokens by bytes has a one wherever a token
covers a byte; the product of one tokenizer's matrix with the transpose of the other's has an entry, the
number of common bytes, for every two tokens that overlap: the links. Byte offsets at which tokens of
both end cut the text into groups; the product of the matrices of tokens by groups links all tokens that
share a group. Matrices are compressed sparse rows, made and multiplied here, row by row (Gustavson):
a product's row is the sum of those rows of the second matrix that the first one's row names.

How many documents hold a pair of ids linked is counted over the corpus from each document's different
pairs, and comes back to the documents as sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table
from touchline.llm.token_ids import portions
from touchline.session import materialise

# Pairs of ids whose counts are sent to every executor: the most frequent ones, so many at most. All
# others are joined by a shuffle.
HOT_PAIRS = 500_000
# Texts are multiplied some at a time, and long ones by so many rows at a time. Bounds memory only.
_CHARACTERS = 500_000
_ROWS = 1 << 17
_SPACE = "▁"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- matrices


@dataclass
class Csr:
    """Compressed sparse rows: row i has its columns at ``indices[indptr[i] : indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens by bytes, from the tokens' ends: each token covers the bytes since the one before."""
    size = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(size), np.ones(size, np.int64), size)


def token_groups(groups: np.ndarray, columns: int) -> Csr:
    """Tokens by groups: each token is in one."""
    return Csr(np.arange(len(groups) + 1), groups, np.ones(len(groups), np.int64), columns)


def transposed(a: Csr) -> Csr:
    """Columns become rows, by a stable counting sort of the entries."""
    order = np.argsort(a.indices, kind="stable")
    rows = np.repeat(np.arange(a.rows), np.diff(a.indptr))
    indptr = np.concatenate([[0], np.cumsum(np.bincount(a.indices, minlength=a.columns))])
    return Csr(indptr, rows[order], a.data[order], a.rows)


def product(a: Csr, b: Csr, low: int = 0, high: int | None = None) -> Csr:
    """Rows ``low`` to ``high`` of the product, row by row: entries of equal row and column are summed."""
    high = a.rows if high is None else high
    upto = a.indptr[low : high + 1]
    entries = slice(upto[0], upto[-1])
    middle = a.indices[entries]
    row = np.repeat(np.arange(high - low), np.diff(upto))
    sizes = b.indptr[middle + 1] - b.indptr[middle]
    # Every entry of a brings a row of b along.
    begin = np.repeat(b.indptr[middle] - (np.cumsum(sizes) - sizes), sizes)
    at = begin + np.arange(len(begin))
    place = np.repeat(row, sizes) * b.columns + b.indices[at]
    value = np.repeat(a.data[entries], sizes) * b.data[at]
    if len(place) and (place[1:] < place[:-1]).any():
        order = np.argsort(place, kind="stable")
        place, value = place[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.empty(0, np.int64)
    place, value = place[new], np.add.reduceat(value, new) if len(new) else value
    row, column = np.divmod(place, max(b.columns, 1))
    return Csr(np.searchsorted(row, np.arange(high - low + 1)), column, value, b.columns)


def _blocks(a: Csr, b: Csr, rows: int = _ROWS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of the product, a block of rows at a time."""
    for low in range(0, a.rows, rows):
        part = product(a, b, low, min(low + rows, a.rows))
        yield low + np.repeat(np.arange(part.rows), np.diff(part.indptr)), part.indices, part.data


# ---------------------------------------------------------------- tokens


@dataclass
class Vocabulary:
    """A tokenizer with the bytes of each of its ids."""

    encode: Callable[[Sequence[str]], list[np.ndarray]]
    pieces: list[bytes]
    # Whether its tokens give every text back, byte for byte.
    exact: bool = False

    def __post_init__(self):
        self.sizes = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))


def _byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """A byte-level vocabulary file. Strings of special tokens inside a text are plain text."""
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    entries, special = content["model"]["vocab"], {t["content"] for t in content["added_tokens"]}
    letters = _byte_letters()
    pieces = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        pieces[i] = bytes(map(letters.__getitem__, entry)) if letters.keys() >= set(entry) else entry.encode()
    # Ids are the merges' ranks but for special entries, which no plain text has.
    ranks = {pieces[i]: i for e, i in entries.items() if e not in special}
    encoding = tiktoken.Encoding(
        "aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(encoding.encode_ordinary(" " + text), np.int64) for text in texts]

    return Vocabulary(encode, pieces, exact=True)


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> Vocabulary:
    """A piece vocabulary file whose encoder puts a space before a text by itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        bytes([int(model.id_to_piece(i)[3:5], 16)])
        if model.is_byte(i)
        else model.id_to_piece(i).replace(_SPACE, " ").encode()
        for i in range(model.get_piece_size())
    ]

    def encode(texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in model.encode(list(texts), num_threads=1)]

    return Vocabulary(encode, pieces)


@dataclass
class Aligned:
    """Some texts in a row with both token sequences, and where each text ends among tokens and bytes."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    upto_a: np.ndarray
    upto_b: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.upto_a) - 1

    def groups(self) -> tuple[np.ndarray, np.ndarray, int]:
        """The group of each token on both sides, and how many groups there are."""
        ends = np.zeros((2, int(self.ends_a[-1]) + 1 if len(self.ends_a) else 1), bool)
        ends[0, self.ends_a] = ends[1, self.ends_b] = True
        last_a, last_b = ends[1, self.ends_a], ends[0, self.ends_b]
        return np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b, int(last_a.sum())

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, common bytes) of all that overlap."""
        yield from _blocks(token_bytes(self.ends_a), transposed(token_bytes(self.ends_b)))

    def shared(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, 1) of all that share a group."""
        of_a, of_b, n = self.groups()
        yield from _blocks(token_groups(of_a, n), transposed(token_groups(of_b, n)))

    @cached_property
    def text_of(self) -> np.ndarray:
        """The text of each token of A."""
        return np.repeat(np.arange(self.texts), np.diff(self.upto_a))


def align(texts: Sequence[str], first: Vocabulary, second: Vocabulary) -> Aligned:
    """Both token sequences of every text. A text that either tokenizer doesn't render has no tokens.

    Empty tokens can't be (every id has bytes), so ends rise strictly and no token is without a byte.
    """
    sides, none = (first, second), np.empty(0, np.int64)
    found = []
    for text, *ids in zip(texts, *(known.encode(texts) for known in sides)):
        whole = (" " + text).encode()
        same = text and all(
            known.exact or b"".join(map(known.pieces.__getitem__, x.tolist())) == whole for known, x in zip(sides, ids)
        )
        found.append(ids if same else (none, none))
    flat = [np.concatenate([none, *(ids[side] for ids in found)]) for side in (0, 1)]
    upto = [np.cumsum([0] + [len(ids[side]) for ids in found]) for side in (0, 1)]
    ends = [np.cumsum(known.sizes[ids]) for known, ids in zip(sides, flat)]
    return Aligned(*flat, *ends, *upto)


class GroupTexts:
    """Groups written as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, first: Vocabulary, second: Vocabulary):
        names = [str(i).encode() for i in range(max(len(first.pieces), len(second.pieces)))]
        self.names = [np.array([n + mark for n in names], object) for mark in (b",", b"|", b";")]

    def of(self, it: Aligned) -> list[bytes]:
        """The groups of every text; a text without tokens has none."""
        of_a, of_b, n = it.groups()
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        parts = np.empty(len(it.a) + len(it.b), object)
        # A token stands after all tokens of earlier groups, and after the A tokens of its own if it is B's.
        parts[np.arange(len(it.a)) + (np.cumsum(in_b) - in_b)[of_a]] = self._marked(it.a, of_a, 1)
        parts[np.arange(len(it.b)) + np.cumsum(in_a)[of_b]] = self._marked(it.b, of_b, 2)
        edges = (it.upto_a + it.upto_b).tolist()
        return [b"".join(parts[low:high].tolist())[:-1] for low, high in zip(edges, edges[1:])]

    def _marked(self, ids: np.ndarray, groups: np.ndarray, mark: int) -> np.ndarray:
        last = np.append(groups[1:] != groups[:-1], True)[: len(ids)]
        return np.where(last, self.names[mark][ids], self.names[0][ids])


# ---------------------------------------------------------------- documents


_FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_shared")
_ALIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(name, pa.int64()) for name in _FIGURES],
        ("groups_sha256", pa.string()),
        ("a", pa.list_(pa.int32())),
        ("b", pa.list_(pa.int32())),
        ("links", pa.list_(pa.int32())),
    ]
)


def _measured(it: Aligned, names: GroupTexts, vocabularies: tuple[int, int]) -> list[pa.Array]:
    """All columns but the key for the texts of ``it``; ids are below the sizes of ``vocabularies``."""
    n, width, span = it.texts, vocabularies[1], vocabularies[0] * vocabularies[1]
    n_links = np.zeros(n, np.int64)
    found = []
    for row, column, _ in it.links():
        text = it.text_of[row]
        n_links += np.bincount(text, minlength=n)
        found.append(np.unique(text * span + it.a[row] * width + it.b[column], return_counts=True))
    pairs, times = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2
    if len(found) > 1:  # a text that several blocks have
        pairs, place = np.unique(pairs, return_inverse=True)
        times = np.bincount(place, times).astype(np.int64)
    text, pair = np.divmod(pairs, span)
    of_a, of_b, groups = it.groups()
    cuts = np.searchsorted(of_a, np.arange(groups)) if groups else np.empty(0, np.int64)
    in_text = it.text_of[cuts]
    shared = np.bincount(of_a, minlength=groups) * np.bincount(of_b, minlength=groups)
    digests = [hashlib.sha256(t).hexdigest() if t else "" for t in names.of(it)]
    lists = pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32())
    return [
        pa.array(np.diff(it.upto_a)),
        pa.array(np.diff(it.upto_b)),
        pa.array(np.bincount(in_text, minlength=n)),
        pa.array(n_links),
        pa.array(np.bincount(in_text, shared, minlength=n).astype(np.int64)),
        pa.array(digests, pa.string()),
        *[pa.ListArray.from_arrays(lists, pa.array(x, pa.int32())) for x in (*np.divmod(pair, width), times)],
    ]


def align_texts(
    df: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None
) -> DataFrame:
    """Per row its figures, the digest of its groups, and its different linked pairs of ids.

    Pair i is ``a[i]`` and ``b[i]``, linked ``links[i]`` times. ``n_shared`` counts pairs of tokens that
    share a group. Null and empty texts, and texts that a tokenizer changes, have no tokens: zeros, empty
    lists and an empty digest. No shuffle; one portion of texts, or one long text, is in memory at a time.
    """
    paths = tokenizers or default_tokenizers()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(paths[0]), sentence_pieces(paths[1])
        names = GroupTexts(first, second)
        for batch in batches:
            for at, texts in portions(batch.column("text"), _CHARACTERS):
                columns = _measured(align(texts, first, second), names, (len(first.pieces), len(second.pieces)))
                keys = batch.column("doc_id").slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([keys, *columns], schema=_ALIGNED)

    given = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    lists = ", ".join(f"{name} array<int>" for name in ("a", "b", "links"))
    figures = ", ".join(f"{name} long" for name in _FIGURES)
    return given.mapInArrow(measure, f"doc_id long, {figures}, groups_sha256 string, {lists}")


def shared_group_links(
    df: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None
) -> DataFrame:
    """(doc_id, token_a, token_b, a, b): all tokens of both sides that share a group, by place and id."""
    paths = tokenizers or default_tokenizers()
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("token_a", "token_b", "a", "b")]])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(paths[0]), sentence_pieces(paths[1])
        for batch in batches:
            for at, texts in portions(batch.column("text"), _CHARACTERS):
                it = align(texts, first, second)
                for row, column, _ in it.shared():
                    text = it.text_of[row]
                    places = row - it.upto_a[text], column - it.upto_b[text], it.a[row], it.b[column]
                    keys = batch.column("doc_id").take(pa.array(at + text))
                    yield pa.RecordBatch.from_arrays([keys, *map(pa.array, places)], schema=schema)

    given = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(linked, "doc_id long, token_a long, token_b long, a long, b long")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): how many rows hold a pair of ids linked, and if no pair of this A id has more.

    Pairs are summed in the map task; the highest counts are one row for each A id at most.
    """
    each = aligned.select(F.inline(F.arrays_zip("a", "b")))
    counts = materialise(each.groupBy("a", "b").agg(F.count("*").alias("n")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _hot_from(counts: DataFrame, most: int) -> int:
    """The least power of two from which on there are at most ``most`` pairs with so high a count."""
    power = F.floor(F.log2("n")).cast("int")
    pairs, low = 0, 64
    for row in sorted(counts.groupBy(power.alias("power")).count().collect(), reverse=True):
        pairs += row["count"]
        if pairs > most:
            break
        low = row.power
    return 2**low if low < 63 else 2**62


def score_links(aligned: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` (a stored table, see :func:`align_texts`) with n_best and count_sum.

    The most frequent pairs, ``hot_pairs`` at most, are broadcast and meet the rows where they are; rarer
    ones are shuffled, and being rare they have no hot key. Which way a pair goes has no part in the result.
    """
    numbered = materialise(aligned.withColumn("_at", F.monotonically_increasing_id()), "aligned-rows")
    counts = materialise(pair_counts(numbered), "pair-counts")
    low = _hot_from(counts, hot_pairs)
    hot, rare = counts.where(F.col("n") >= low), counts.where(F.col("n") < low)
    each = numbered.select("_at", F.inline(F.arrays_zip("a", "b", "links")))
    met = each.join(F.broadcast(hot), ["a", "b"], "left")

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_at").agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("n")).alias("count_sum"),
        )

    found = sums(met.where(F.col("n").isNotNull()))
    if low > 1:
        left = met.where(F.col("n").isNull()).select("_at", "a", "b", "links")
        rest = sums(left.join(rare, ["a", "b"]))
        found = found.unionByName(rest).groupBy("_at").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    zero = F.lit(0).cast("long")
    return numbered.join(found, "_at", "left").select(
        *aligned.columns, *[F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")]
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of all documents under two tokenizers, with corpus-wide counts.

    Every row is a document: a repeated row counts again. Rows without id are in the result.
    """
    aligned = align_texts(table(spark, sf_dir, "documents"))
    return score_links(aligned).drop("a", "b", "links")

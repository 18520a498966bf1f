"""Packing of token sequences into fixed windows by best fit decreasing.

Documents are cut into full windows and a rest. Within a bin of pieces, dealt out at random and of
bounded size, pieces go longest first into the open window that they fill tightest. A segment tree
over the remaining capacities finds that window in a step per level.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table
from touchline.llm.token_ids import portions, token_ids
from touchline.session import materialise

WINDOW = 2048
END = 1
# Pieces packed together: enough that the last, half-filled windows don't matter, little enough for one task.
PIECES = 8192
def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_BIN_SHIFT = 32
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def cut_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every row: full windows first, then what is left.

    Every document ends with the id ``end``; a null or empty text is that id alone. ``ids`` has the
    token ids (little-endian, 32 bits) if asked for, else null. A long text is tokenised whole, alone in its
    portion: some 60 bytes of memory for each of its tokens; its pieces are packed apart from one another.
    """
    path = tokenizer or default_tokenizer()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = token_ids(path)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            keys = batch.column("doc_id").to_pylist()
            for at, texts in portions(batch.column("text")):
                for doc_id, ids in zip(keys[at:], known.of(texts)):
                    ids = ids.tobytes() + last
                    tokens = len(ids) // 4
                    for start in range(0, tokens, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append(
                            (doc_id, start, len(piece) // 4, zlib.crc32(piece), tokens, piece if with_ids else None)
                        )
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    given = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(pieces, _PIECES)


class OpenWindows:
    """Open windows by remaining capacity: a segment tree whose nodes tell if anything is below."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        if len(self.windows[capacity]) == 1:
            node = capacity + self.leaves
            while node:
                self.filled[node] += 1
                node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least remaining capacity of at least ``need``, taken out."""
        filled, node = self.filled, need + self.leaves
        while not filled[node]:
            while node & 1:  # a right child: nothing further right below this parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not filled[node]:
                node += 1
        capacity = node - self.leaves
        window = self.windows[capacity].pop()
        if not self.windows[capacity]:
            while node:
                filled[node] -= 1
                node >>= 1
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of every piece. ``lengths`` must come longest first."""
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_windows, used = OpenWindows(window), 0
    for at, length in enumerate(lengths.tolist()):
        found = open_windows.take(length)
        if found is None:
            found = (window, used)
            used += 1
        capacity, number[at] = found
        offset[at] = window - capacity
        if capacity > length:
            open_windows.add(capacity - length, found[1])
    return number, offset


def pack(pieces: DataFrame, window: int = WINDOW, bin_size: int = PIECES) -> DataFrame:
    """``pieces`` (see :func:`cut_documents`) with ``sequence_id`` and ``offset``.

    The pieces are written with a number each, and the number's hash deals them into bins of about
    ``bin_size``: bins are even whatever documents are repeated, and a rerun of a task finds the same
    pieces. A sequence id is the bin's number and the window's number in it.
    """
    placed = materialise(pieces.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    bins = -(-placed.count() // bin_size) or 1

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("_at", "ascending")])
        number, offset = best_fit_decreasing(group["length"].to_numpy(), window)
        first = group["_bin"].to_numpy().astype(np.int64) << _BIN_SHIFT
        return (
            group.drop_columns(["_bin", "_at"])
            .append_column("sequence_id", pa.array(first + number))
            .append_column("offset", pa.array(offset))
        )

    return (
        placed.withColumn("_bin", F.pmod(F.xxhash64("_at"), F.lit(bins)))
        .groupBy("_bin")
        .applyInArrow(packed, f"{_PIECES}, sequence_id long, offset long")
    )


def pack_documents(df: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """All documents of ``df`` cut and packed; one row per piece. No rows, no pieces."""
    return pack(cut_documents(df, window=window, **options), window)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2,048 tokens; every piece with its place and check sum."""
    return pack_documents(table(spark, sf_dir, "documents")).drop("ids")

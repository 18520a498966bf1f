"""Nearest neighbours by inner product, as a join of blocks of queries with tiles of candidates.

Queries are dealt into blocks and candidates into stripes; every block meets every stripe once, in one
task, tile by tile. In a tile both sides are rounded to signed bytes, and the product of the byte
matrices gives every score with a bound on its error:

    q.c = q'.c' + q'.(c - c') + (q - q').c,   so   |q.c - q'.c'| <= |q'| |c - c'| + |q - q'| |c|

Pairs whose upper bound can't reach the query's list are done. The rest are recomputed from the
original vectors in double precision and pushed into the query's heap. No pair is left out unseen, so
the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import table

K = 20
QUERY_STEP = 20
# Queries of a block and candidates of a stripe, at most: what a task holds, and what it reads as a stream.
# A larger block copies the candidates less often.
BLOCK = 16_384
STRIPE = 262_144
# Queries and candidates whose bounds are worked out at once.
_ROWS, _TILE = 1024, 2048
# Integer sums of byte products are exact in single precision up to this many components.
_SINGLE = (1 << 24) // (127 * 127)
_NO_ID = 2**63 - 1


def usable(vector: Column) -> Column:
    """True for vectors without null, NaN or infinity that aren't all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class _Side:
    """Vectors in bytes, with what the error bound needs of them."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors = vectors.astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            self.scale = np.abs(vectors).max(axis=1) / 127
            self.scale[self.scale == 0] = np.finfo(float).tiny
            codes = np.rint(vectors / self.scale[:, None])
            rounded = codes * self.scale[:, None]
            self.codes = codes.astype(np.int8)
            self.norm = np.sqrt((vectors * vectors).sum(axis=1))
            self.rounded = np.sqrt((rounded * rounded).sum(axis=1))
            self.lost = np.sqrt(((vectors - rounded) ** 2).sum(axis=1))


def _bounds(q: _Side, c: _Side) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the score of every pair."""
    kind = np.float32 if q.codes.shape[1] <= _SINGLE else np.float64
    with np.errstate(over="ignore", invalid="ignore"):
        score = (q.codes.astype(kind) @ c.codes.astype(kind).T).astype(np.float64)
        score *= q.scale[:, None]
        score *= c.scale[None, :]
        error = np.outer(q.rounded, c.lost) + np.outer(q.lost, c.norm)
        error += 1e-9 * np.outer(q.norm, c.norm)  # the rounding of this very sum
        low, high = score - error, score + error
    low[np.isnan(low)], high[np.isnan(high)] = -np.inf, np.inf
    return low, high


class _Block:
    """Some queries and, for each, the heap of its best candidates so far."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.rows, self.ids, self.k, self.side = rows, ids, k, _Side(vectors)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, tile: _Side) -> None:
        low, high = _bounds(self.side, tile)
        own = self.ids[:, None] == ids[None, :]
        low[own], high[own] = -np.inf, -np.inf
        if len(ids) > self.k:
            np.maximum(self.least, np.partition(low, -self.k, axis=1)[:, -self.k], out=self.least)
        left = (high >= self.least[:, None]) & ~own
        for at in np.flatnonzero(left.any(axis=1)):
            near = np.flatnonzero(left[at])
            # A running sum adds up component by component, the same way for every vector.
            scores = (self.side.vectors[at] * tile.vectors[near]).cumsum(axis=1)[:, -1]
            heap = self.heaps[at]
            for pair in zip(scores.tolist(), (-ids[near]).tolist()):
                if len(heap) < self.k:
                    heapq.heappush(heap, pair)
                elif pair > heap[0]:
                    heapq.heapreplace(heap, pair)
            if len(heap) == self.k:
                self.least[at] = max(self.least[at], heap[0][0])

    def found(self) -> pa.RecordBatch:
        rows = [(r, q, -i, s) for r, q, heap in zip(self.rows.tolist(), self.ids.tolist(), self.heaps) for s, i in heap]
        row, query, near, score = list(zip(*rows)) or [()] * 4
        near = [None if i == _NO_ID else i for i in near]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        columns = [pa.array(x, kind) for x, kind in zip((row, query, near, score), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["row", "query_id", "vec_id", "score"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of equal (dim, cell, is_candidate) of rows that come in that order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("dim", "cell", "is_candidate")]
        change = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
        for start, end in zip([0, *change], [*change, batch.num_rows]):
            yield tuple(int(m[start]) for m in marks), batch.slice(start, end - start)


def _vectors(part: pa.RecordBatch) -> np.ndarray:
    column = part.column("vector")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, blocks = None, [], []
        for (dim, cell, is_candidate), part in _runs(batches):
            if at != (dim, cell):
                yield from (block.found() for block in blocks)
                at, waiting, blocks = (dim, cell), [], []
            ids, vectors = part.column("id").to_numpy(zero_copy_only=False), _vectors(part)
            if not is_candidate:
                waiting.append((part.column("row").to_numpy(zero_copy_only=False), ids, vectors))
                continue
            if not blocks:
                if not waiting:
                    continue
                asked, waiting = [np.concatenate(x) for x in zip(*waiting)], [()]
                blocks = [_Block(*(x[low : low + _ROWS] for x in asked), k) for low in range(0, len(asked[0]), _ROWS)]
            for start in range(0, len(ids), _TILE):
                tile = _Side(vectors[start : start + _TILE])
                for block in blocks:
                    block.meet(ids[start : start + _TILE], tile)
        yield from (block.found() for block in blocks)

    return search


def layout(queries: int, candidates: int, cores: int, block: int = BLOCK, stripe: int = STRIPE) -> tuple[int, int]:
    """How many blocks and stripes there are: none is larger than asked for, and cells are enough for all cores."""
    blocks = -(-queries // block) or 1
    return blocks, max(1, -(-candidates // stripe), -(-2 * cores // blocks))


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    key: str,
    vector: str,
    k: int = K,
    block: int = BLOCK,
    stripe: int = STRIPE,
) -> DataFrame:
    """For every query row its ``k`` best candidates: query_id, rank (from 1), vec_id, score.

    Nearest first, ties to the smaller id, a candidate without id last. A query's own id is no
    candidate. Vectors that are null, zero or hold null, NaN or infinity take no part; vectors of
    different lengths never meet. Repeated query rows get a list each; repeated candidates fill a
    place each. Fewer than ``k`` candidates are all listed; without any, a query has no row.
    """
    spark = queries.sparkSession
    fields = lambda df: df.where(usable(F.col(vector))).select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.col(vector).alias("vector"),
        F.size(vector).alias("dim"),
        F.monotonically_increasing_id().alias("row"),
    )
    asked, offered = fields(queries), fields(candidates)
    blocks, stripes = layout(
        asked.count(), candidates.count(), spark.sparkContext.defaultParallelism, block, stripe
    )
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = asked.withColumn("_block", dealt(blocks)).withColumn("_stripe", every(stripes))
    offered = offered.withColumn("_stripe", dealt(stripes)).withColumn("_block", every(blocks))
    cells = [
        side.select(
            "dim",
            (F.col("_block") * stripes + F.col("_stripe")).alias("cell"),
            F.lit(number).alias("is_candidate"),
            "row",
            "id",
            "vector",
        )
        for number, side in enumerate((asked, offered))
    ]
    met = (
        cells[0]
        .unionByName(cells[1])
        .repartition(blocks * stripes, "dim", "cell")
        .sortWithinPartitions("dim", "cell", "is_candidate")
        .mapInArrow(_searcher(k), "row long, query_id long, vec_id long, score double")
    )
    best = W.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    query = F.when(F.col("query_id") != _NO_ID, F.col("query_id")).alias("query_id")
    return ranked.select(query, "rank", "vec_id", "score")


def op9_block_matrix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose vec_id is divisible by 20; see :func:`nearest`."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors.where(F.col("vec_id") % QUERY_STEP == 0), vectors, "vec_id", "embedding")

"""Near-duplicate documents by SetSketch registers over word shingles.

A register is the smallest of a set's exponentially distributed hashes on a logarithmic scale, cut off
at both ends. Registers of a union are the larger of the sets' registers, so sketches can be merged;
equal registers are about as likely as two sets are similar, so bands of registers find candidates.
For a pair, the numbers of larger, equal and smaller registers together with the set sizes give the
similarity by maximum likelihood; pairs that may be similar are verified on their whole shingle sets.

Work stays linear in what is alike: equal sets are one node. Nodes that share a band are in the group of
that band's hub, its most popular node. Every node first meets its hubs, which connects nearly all that
is alike; only nodes that aren't connected with their hub then meet the others of the group, in blocks of
bounded size, and no pair that is connected already is looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table
from touchline.llm.components import connected_components
from touchline.llm.words import WordHashes, give_back, window_hashes
from touchline.operators.joins import fits_broadcast
from touchline.session import materialise

SHINGLE = 5
# The limit of op3's contract, and the one of the pipeline's stage.
LINK_PERCENT = 85
STAGE_PERCENT = 80
REGISTERS = 156
# Of the pairs at a limit, the share that may have no band in common.
MISS = 5e-6
BASE = 1.001
RATE = 20.0
TOP = 2**16 - 2
BLOCK = 128
# Bytes of text in a block, about; a single longer text is a block of its own.
BLOCK_BYTES = 8_000_000
# Nodes that meet their hub in one task.
STAR = 64
_CHUNK = 512

# Odd multipliers: each is another order of the 32-bit numbers.
_FACTORS = np.random.default_rng(20240229).integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_STEPS = np.linspace(0, 1, 201)[:, None]


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """The sorted different hashes of a text's shingles: A-Z lower-cased, five words each.

    Fewer words are one shingle of their own; no words, no shingles.
    """
    words = hashes.of(text.encode().lower().split())
    if 0 < len(words) < SHINGLE:
        return window_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(window_hashes(words, SHINGLE))


def registers(elements: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes, by their upper halves; empty sets have all registers 0."""
    if not len(elements):
        return np.zeros(REGISTERS, np.uint16)
    half = (elements >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max)
    for at in range(0, len(half), _CHUNK):
        np.minimum(least, (_FACTORS[:, None] * half[None, at : at + _CHUNK]).min(axis=1), out=least)
    shortest = -np.log1p(-(least.astype(np.float64) + 0.5) * 2.0**-32) / RATE
    return np.clip(np.floor(1 - np.log(shortest) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def similarity(larger: np.ndarray, smaller: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity by maximum likelihood.

    ``larger`` and ``smaller`` count the registers of the first set above and below those of the
    second, ``n`` and ``m`` are the sets' sizes. The likelihood is looked at in steps of 0.005.
    """
    found = np.empty(len(n))
    for at in range(0, len(n), 1024):  # all steps at once, for so many pairs
        part = slice(at, at + 1024)
        u, v = n[part] / (n[part] + m[part]), m[part] / (n[part] + m[part])
        j = np.minimum(_STEPS, np.minimum(n[part] / m[part], m[part] / n[part]))
        above, below = _chance(u - v * j), _chance(v - u * j)
        counts = larger[part], smaller[part], REGISTERS - larger[part] - smaller[part]
        likelihood = sum(c * np.log(np.maximum(p, 1e-300)) for c, p in zip(counts, (above, below, 1 - above - below)))
        found[part] = j[likelihood.argmax(axis=0), np.arange(j.shape[1])]
    return found


def _chance(x: np.ndarray) -> np.ndarray:
    """How likely a register is larger, by the share of elements that only its set has."""
    return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)


@cache
def bands_of(limit: int = LINK_PERCENT) -> tuple[int, int]:
    """(bands, registers in each): the longest bands of which pairs at the limit miss all in MISS cases at most."""
    miss = lambda rows: (1 - (limit / 100) ** rows) ** (REGISTERS // rows)
    rows = next((r for r in range(REGISTERS // 2, 1, -1) if miss(r) <= MISS), 1)
    return REGISTERS // rows, rows


def band_miss(limit: int = LINK_PERCENT) -> float:
    """Which share of the pairs at the limit have no band in common."""
    bands, rows = bands_of(limit)
    return (1 - (limit / 100) ** rows) ** bands


@cache
def least_estimate(limit: int = LINK_PERCENT) -> float:
    """Estimates below are not verified; of pairs at the limit no more are lost by it than by the bands.

    A register is equal about as likely as the limit says, so equal ones are a binomial count. Two
    steps of the estimate are left for sets of unlike sizes.
    """
    j, missed, equal = limit / 100, 0.0, 0
    while equal < REGISTERS:
        missed += comb(REGISTERS, equal) * j**equal * (1 - j) ** (REGISTERS - equal)
        if missed > band_miss(limit):
            break
        equal += 1
    apart = np.array([REGISTERS - equal])
    return float(similarity(apart // 2, apart - apart // 2, np.ones(1), np.ones(1))[0]) - 0.01


def text_key(text: Column) -> Column:
    """What a text is found again by: 128 bits. Null for null."""
    return F.unhex(F.md5(text.cast("binary")))


_SKETCH = "doc_id long, text_key binary, n_bytes long, n_shingles long, node binary, registers binary"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, nodes, sketches = [], [], []
        for value in batch.column("text"):
            found = shingles(value.as_py() or "", hashes)
            sizes.append(len(found))
            nodes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            sketches.append(registers(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                batch.column("n_bytes"),
                pa.array(sizes, pa.int64()),
                pa.array(nodes, pa.binary()),
                pa.array(sketches, pa.binary()),
            ],
            ["doc_id", "text_key", "n_bytes", "n_shingles", "node", "registers"],
        )
    hashes.clear()
    give_back()


def sketch(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its set's size, digest (``node``; null for an empty set) and registers."""
    given = df.select(
        F.col(key).cast("long").alias("doc_id"),
        text_key(F.col(text)).alias("text_key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    return given.mapInArrow(_sketched, _SKETCH)


def hub_groups(nodes: DataFrame, limit: int = LINK_PERCENT) -> DataFrame:
    """(hub, popularity, id): which nodes are to be compared under which hub; a hub is in its own group.

    Nodes that share a band key are in the group of that key's hub, the node that shares most keys
    with others. So two nodes with a common key always meet, whatever their hub has to do with them.
    """
    bands, rows = bands_of(limit)
    width = 2 * rows
    band = lambda i: F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width))
    keyed = nodes.select("id", F.explode(F.array(*[band(i) for i in range(bands)])).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = materialise(keyed.join(shared, "key"), "near-members")
    popularity = members.groupBy("id").agg(F.sum("size").alias("popularity"))
    ranked = materialise(members.select("id", "key").join(popularity, "id"), "near-ranked")
    most = ranked.groupBy("key").agg(F.max(F.struct("popularity", "id")).alias("most"))
    hubs = most.select("key", F.col("most.id").alias("hub"), "most.popularity")
    return ranked.select("id", "key").join(hubs, "key").select("hub", "popularity", "id").distinct()


class _Forest:
    """Which members of a block are connected by links found so far."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, at: int) -> int:
        while self.up[at] != at:
            self.up[at] = at = self.up[self.up[at]]
        return at


def _may_link(n: np.ndarray, m: float, larger: np.ndarray, smaller: np.ndarray, limit: int) -> np.ndarray:
    """Whether sizes and registers leave it possible that sets of ``n`` and ``m`` elements link."""
    ratio = np.minimum(n, m) / np.maximum(n, m)
    return (ratio * 100 >= limit) & (larger + smaller <= max(0.5, 2 - limit / 50) * REGISTERS)


def _linked_sets(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= limit * (len(a) + len(b) - common)


def block_links(
    ids: list[int],
    sets: list[np.ndarray],
    sketches: np.ndarray,
    across: np.ndarray | None,
    limit: int = LINK_PERCENT,
    parts: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Links that connect the members of a block, each verified on the whole sets: ``limit`` of 100 shingles.

    With ``across`` (a side, 0 or 1, for every member) only pairs of both sides are compared. Members of
    equal ``parts`` are connected already. Pairs go by falling estimate; a pair that is connected isn't
    verified again.
    """
    n = np.array([len(s) for s in sets], float)
    found = []
    for at in range(len(ids) - 1):
        rest = slice(at + 1, None)
        larger = (sketches[at] > sketches[rest]).sum(axis=1)
        smaller = (sketches[at] < sketches[rest]).sum(axis=1)
        may = _may_link(n[rest], n[at], larger, smaller, limit)
        if across is not None:
            may &= across[rest] != across[at]
        if parts is not None:
            may &= parts[rest] != parts[at]
        near = np.flatnonzero(may)
        found.append((np.full(len(near), at), near + at + 1, larger[near], smaller[near]))
    first, second, larger, smaller = (np.concatenate(x) for x in zip(*found))
    estimate = similarity(larger, smaller, n[first], n[second])
    pairs = [p for p in zip((-estimate).tolist(), first.tolist(), second.tolist()) if -p[0] >= least_estimate(limit)]
    forest, links = _Forest(len(ids)), []
    for part in {} if parts is None else {p: np.flatnonzero(parts == p) for p in set(parts.tolist())}.values():
        for other in part[1:].tolist():
            forest.up[other] = int(part[0])
    for _, a, b in sorted(pairs):
        if (x := forest.root(a)) == (y := forest.root(b)):
            continue
        if _linked_sets(sets[a], sets[b], limit):
            forest.up[x] = y
            links.append((ids[a], ids[b]))
    return links


def _rows(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    return chain.from_iterable(zip(*(batch.column(name).to_pylist() for name in names)) for batch in batches)


def _linked(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of (hub, lo, hi, block, part, id, text, registers) in that order to links."""
    hashes = WordHashes()

    def close(key, members):
        if len(members) < 2:
            return []
        sets = [shingles(m[6] or "", hashes) for m in members]
        sketches = np.stack([np.frombuffer(m[7], np.uint16) for m in members])
        across = None if key[1] == key[2] else np.array([m[3] == key[1] for m in members])
        parts = np.array([m[4] for m in members])
        return block_links([m[5] for m in members], sets, sketches, across, limit, parts)

    key, members, found = None, [], []
    for row in _rows(batches, ("hub", "lo", "hi", "block", "part", "id", "text", "registers")):
        if row[:3] != key:
            found += close(key, members)
            key, members = row[:3], []
        members.append(row)
        if len(found) >= 4096:
            yield _batch(found)
            found = []
    yield _batch(found + close(key, members))
    hashes.clear()
    give_back()


def _linked_to_hubs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of (hub, star, id, text, registers), the hub's own first in each star, to links with the hub.

    Two sets are in memory at a time, that of the hub and that of one node.
    """
    hashes, found, hub = WordHashes(), [], None
    for name, _, at, text, content in _rows(batches, ("hub", "star", "id", "text", "registers")):
        sketch_of = np.frombuffer(content, np.uint16)
        if name == at:
            hub = shingles(text or "", hashes), sketch_of
            continue
        own = shingles(text or "", hashes)
        larger, smaller = np.array([(sketch_of > hub[1]).sum()]), np.array([(sketch_of < hub[1]).sum()])
        n, m = np.array([float(len(own))]), float(len(hub[0]))
        if not _may_link(n, m, larger, smaller, limit)[0]:
            continue
        if similarity(larger, smaller, n, np.array([m]))[0] >= least_estimate(limit) and _linked_sets(own, hub[0], limit):
            found.append((name, at))
            if len(found) >= 4096:
                yield _batch(found)
                found = []
    yield _batch(found)
    hashes.clear()
    give_back()


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = list(zip(*links)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _beside(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` (a stored table without texts) with the text and registers of their ``id``.

    Rows are broadcast up to a measured size, so that texts are shuffled once, to where they meet.
    """
    small = fits_broadcast({"rows": rows})["rows"]
    return texts.join(F.broadcast(rows) if small else rows, "id")


def star_links(pairs: DataFrame, texts: DataFrame, limit: int = LINK_PERCENT) -> DataFrame:
    """Verified links (a, b) among ``pairs`` (hub, id): every node meets its hub, STAR nodes in a task.

    A node's text travels once for each of its pairs and a hub's once for every STAR nodes.
    """
    sizes = pairs.groupBy("hub").agg(F.count("*").alias("size"))
    stars = F.ceil(F.col("size") / STAR).cast("int")
    members = pairs.join(sizes, "hub").select("hub", "id", F.pmod(F.xxhash64("id"), stars).cast("int").alias("star"))
    hubs = sizes.select("hub", F.col("hub").alias("id"), F.explode(F.sequence(F.lit(0), stars - 1)).alias("star"))
    rows = materialise(members.unionByName(hubs), "near-stars")
    return (
        _beside(rows, texts)
        .repartition("hub", "star")
        .sortWithinPartitions("hub", "star", F.col("id") != F.col("hub"), "id")
        .mapInArrow(lambda batches: _linked_to_hubs(batches, limit), "a long, b long")
    )


def _labelled(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """``groups`` with ``part`` and ``hub_part``: what node and hub are connected with so far."""
    part = labels.select("id", F.col("component").alias("part"))
    of_hub = labels.select(F.col("id").alias("hub"), F.col("component").alias("hub_part"))
    return groups.join(part, "id", "left").join(of_hub, "hub", "left").withColumns(
        {"part": F.coalesce("part", "id"), "hub_part": F.coalesce("hub_part", "hub")}
    )


def cells(groups: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(hub, lo, hi, block, part, id): where the nodes meet that aren't connected with their hub.

    ``groups`` has hub, id, part, hub_part and n_bytes. A group whose nodes are all connected with the hub
    has no cell. The nodes that aren't are dealt into blocks that meet each other, and meet the blocks of
    those that are; blocks of the latter don't meet. A block has about ``block`` nodes and ``block_bytes``
    bytes at most.
    """
    own = F.col("part") == F.col("hub_part")
    sizes = groups.groupBy("hub").agg(
        *[F.count(F.when(side, 1)).alias(f"n_{name}") for name, side in (("in", own), ("out", ~own))],
        *[F.sum(F.when(side, F.col("n_bytes"))).alias(f"bytes_{name}") for name, side in (("in", own), ("out", ~own))],
    )

    def blocks(name: str) -> Column:
        by_bytes = F.ceil(F.coalesce(f"bytes_{name}", F.lit(0)) / block_bytes)
        return F.greatest(F.ceil(F.col(f"n_{name}") / block), by_bytes).cast("int")

    sizes = sizes.where("n_out > 0").select("hub", blocks("in").alias("inner"), blocks("out").alias("outer"))
    draw = F.xxhash64("id")
    # Outer blocks come first; an inner node meets the outer blocks, an outer one all blocks.
    number = F.when(own, F.col("outer") + F.pmod(draw, "inner")).otherwise(F.pmod(draw, "outer")).cast("int")
    last = F.when(own, F.col("outer")).otherwise(F.col("outer") + F.col("inner"))
    return (
        groups.join(sizes, "hub")
        .select("hub", "part", "id", number.alias("block"), F.explode(F.sequence(F.lit(0), last - 1)).alias("other"))
        .select("hub", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "part", "id")
    )


def find_links(nodes: DataFrame, texts: DataFrame, block: int = BLOCK, limit: int = LINK_PERCENT) -> DataFrame:
    """Verified links (a, b) between nodes, enough of them to connect all that is linked.

    ``nodes`` has id, doc_id, text_key, n_bytes and registers, ``texts`` doc_id, text_key and text. First
    every node meets the most popular of its hubs, then those of its other hubs that it isn't connected
    with yet; see :func:`cells` for what meets after that. A family of copies costs a few texts for each
    of its nodes however large it is; only nodes that share a band with a family and aren't connected
    with its hub meet the whole of it.
    """
    groups = materialise(hub_groups(nodes, limit), "near-groups")
    wanted = materialise(groups.select("id").distinct().join(nodes, "id"), "near-nodes")
    held = wanted.select("id", "doc_id", "text_key")
    listed = F.broadcast(held) if fits_broadcast({"held": held})["held"] else held
    same = texts["doc_id"].eqNullSafe(held["doc_id"]) & (texts["text_key"] == held["text_key"])
    fetched = texts.join(listed, same).select("id", "text").dropDuplicates(["id"])
    sources = materialise(fetched.join(wanted.select("id", "registers"), "id"), "near-texts")

    pairs = groups.where("hub <> id")
    first = pairs.groupBy("id").agg(F.max(F.struct("popularity", "hub"))["hub"].alias("hub"))
    links = materialise(star_links(materialise(first, "near-pairs"), sources, limit), "near-links")
    apart = _labelled(pairs, connected_components(links)).where("part <> hub_part").select("hub", "id")
    apart = apart.join(first, ["hub", "id"], "left_anti")
    more = materialise(star_links(materialise(apart, "near-pairs"), sources, limit), "near-links")
    links = links.unionByName(more)
    if not more.isEmpty():
        links = materialise(links, "near-links")
    left = _labelled(groups, connected_components(links)).join(wanted.select("id", "n_bytes"), "id")
    met = _beside(materialise(cells(left, block), "near-cells"), sources)
    return links.unionByName(
        met.repartition("hub", "lo", "hi")
        .sortWithinPartitions("hub", "lo", "hi", "id")
        .mapInArrow(lambda batches: _linked(batches, limit), "a long, b long")
    )


def group(
    df: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, limit: int = LINK_PERCENT
) -> DataFrame:
    """Every row with n_shingles, component_id and kept, and ``text_key`` (a hash of its text).

    Rows are linked whose sets have ``limit`` of 100 shingles in common. component_id is the smallest key of all rows that links connect the row with. Empty sets (null,
    empty or blank texts) are linked with nothing. Rows without key take part; a group of which no
    row has a key has component_id null. Rows with the smallest key of their group are kept, so a row
    repeated with its key is kept as often as it is there.
    """
    sketched = materialise(sketch(df, key, text), "near-sketches")
    sets = sketched.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("smallest"),
        F.min(F.struct("doc_id", "text_key", "n_bytes")).alias("holder"),  # the row that gives the text
        F.first("registers").alias("registers"),
    )
    nodes = sets.select(F.monotonically_increasing_id().alias("id"), "node", "smallest", "holder.*", "registers")
    nodes = materialise(nodes, "near-sets")
    texts = df.select(
        F.col(key).cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )
    found = find_links(nodes.drop("node", "smallest"), texts, block, limit)
    links = materialise(found.distinct(), "near-links")
    labels = connected_components(links)
    placed = nodes.select("node", "id", "smallest").join(labels, "id", "left")
    placed = placed.select("node", "smallest", F.coalesce("component", "id").alias("component"))
    least = placed.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = materialise(
        placed.join(least, "component").select(F.col("node").alias("_node"), "component_id"), "near-components"
    )
    return (
        sketched.select("doc_id", "text_key", "n_shingles", "node")
        .join(named, F.col("node") == F.col("_node"), "left")
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "text_key",
        )
    )


def without_near_duplicates(documents: DataFrame, limit: int = STAGE_PERCENT) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; all columns as they were.

    Columns of any name may be there: the row travels as one struct.
    """
    gone = group(documents, limit=limit).where(~F.col("kept")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
    )
    gone = materialise(gone.distinct(), "near-gone")
    # Ids alone, so often small next to the texts: measured, and beyond the limit both sides are shuffled.
    listed = F.broadcast(gone) if fits_broadcast({"gone": gone})["gone"] else gone
    same = F.col("row")["doc_id"].eqNullSafe(F.col("_id")) & (text_key(F.col("row")["text"]) == F.col("_key"))
    left = documents.select(F.struct("*").alias("row")).join(listed, same, "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in documents.columns])


def op3_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of all documents; see :func:`group`."""
    return group(table(spark, sf_dir, "documents")).drop("text_key")

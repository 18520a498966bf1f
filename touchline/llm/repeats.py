"""Repeated passages across documents, by enhanced suffix arrays over anchored blocks.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller id. To find those strings without bringing all suffixes together:

1. Every window of ``LENGTH`` bytes has an anchor: the leftmost smallest hash among its runs of ``GRAM``
   bytes. Equal windows have equal anchors. The consecutive windows of one anchor are a block, about
   one for every fourteen bytes.
2. Anchors are counted by hash bucket. Only those that come with two or more blocks matter further on;
   copies of a text are in one chunk and need no other.
3. Blocks with the same anchor meet. The suffixes of the different blocks that hold a whole window are
   sorted, and a stack scan over their common prefixes yields the interval tree: every interval of at
   least ``LENGTH`` common bytes whose members are preceded by different bytes is a maximal repeat, with
   all its occurrences. All but the occurrences in the smallest document are marked.
4. The marks go back to the documents.

An anchor with more than ``HOT`` blocks (of a line that half of the corpus has) stands in too many
different contexts for one task. Its windows are compared one by one: the smallest document of each by
an aggregation that begins in the map task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from inspect import signature

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import table
from touchline.llm.words import eight_bytes, give_back, mixed, span_hashes
from touchline.session import materialise

LENGTH = 50
GRAM = 24
HOT = 1000
COPIES = 256
CHUNK_BYTES = 8 << 20
_WIDTH = LENGTH - GRAM + 1
_LONGEST = LENGTH + _WIDTH - 1  # of a block
_ROW = -(-_LONGEST // 8) * 8
_SLICE = 1 << 20
_NO_ID = 2**63 - 1
_LOW = np.uint64(2**32 - 1)
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@dataclass
class Runs:
    """Blocks of a buffer: first and last window start, anchor place and hash, and the document."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray

    def __getitem__(self, at: np.ndarray) -> Runs:
        return Runs(self.first[at], self.last[at], self.anchor[at], self.doc[at])


def _slice_runs(part: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start and anchor hash of the runs among the valid window starts of a slice."""
    eight = eight_bytes(part)
    grams = len(part) - GRAM + 1
    h = eight[:grams] * _MULTIPLIERS[0]
    for step in (1, 2):
        h += eight[8 * step : 8 * step + grams] * _MULTIPLIERS[step]
    h = mixed(h)
    # The order is the upper half of the hash; of equal ones the leftmost is smallest.
    least = (h & ~_LOW) | np.arange(grams, dtype=np.uint64)
    size = 1
    while 2 * size <= _WIDTH:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(valid)], least[_WIDTH - size : _WIDTH - size + len(valid)])
    place = least & _LOW
    same = np.zeros(len(valid) + 1, bool)
    same[1:-1] = (place[1:] == place[:-1]) & valid[1:] & valid[:-1]
    first, last = np.flatnonzero(valid & ~same[:-1]), np.flatnonzero(valid & ~same[1:])
    return first, last, h[place[first].astype(np.int64)]


def runs(data: np.ndarray, ends: np.ndarray) -> Runs:
    """The blocks of texts that stand one after another in ``data``, ending at ``ends``.

    Works through slices, so that memory doesn't grow with a text; a block may be cut at a slice's end.
    """
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    windows, found = max(len(data) - LENGTH + 1, 0), []
    for at in range(0, windows, _SLICE):
        until = min(windows, at + _SLICE)
        edge = np.zeros(until - at + 1, np.int32)
        low, high = np.searchsorted(ends, at, side="right"), np.searchsorted(ends, until + LENGTH, side="right")
        for sign, places in ((1, np.maximum(ends - LENGTH + 1, starts)), (-1, ends)):
            np.add.at(edge, np.clip(places[low : high + 1], at, until) - at, sign)
        valid = np.cumsum(edge[:-1]) == 0
        first, last, anchor = _slice_runs(data[at : until + LENGTH - 1], valid)
        found.append((first + at, last + at, anchor))
    first, last, anchor = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    return Runs(first, last, anchor.astype(np.uint64), np.searchsorted(ends, first, side="right"))


class Chunk:
    """The documents of one chunk: their bytes in a row, their ids and their blocks."""

    def __init__(self, group: pa.Table):
        column = pa.concat_arrays(group["text"].chunks) if group["text"].num_chunks else pa.array([], pa.string())
        width = np.int64 if pa.types.is_large_string(column.type) else np.int32
        offsets = np.frombuffer(column.buffers()[1] or bytes(8), width)
        offsets = offsets[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        whole = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.ends = (offsets[1:] - offsets[0]).astype(np.int64)
        self.ids = group["id"].to_numpy()
        self.runs = runs(self.data, self.ends)

    def blocks(self, chosen: Runs) -> np.ndarray:
        eight = eight_bytes(self.data, _LONGEST)
        return span_hashes(eight, chosen.first, chosen.last - chosen.first + LENGTH, _LONGEST)

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return span_hashes(eight_bytes(self.data, _LONGEST), starts, np.full(len(starts), LENGTH), LENGTH)


def _least(keys: Sequence[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows with two key columns: one row of each key, each row's key number, and the smallest id by key."""
    first, second = (k.view(np.uint64) for k in keys)
    order = np.argsort(mixed(first) ^ second)
    new = np.ones(len(order), bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids[:0]
    return order[starts], number, least


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which rows have a key that another row has too."""
    order = np.argsort(keys)
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    found = np.empty(len(order), bool)
    found[order] = same[1:] | same[:-1]
    return found


def _spread(chosen: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Every window start of the runs, and the run it is in."""
    size = chosen.last - chosen.first + 1
    owner = np.repeat(np.arange(len(size)), size)
    return np.repeat(chosen.first - (np.cumsum(size) - size), size) + np.arange(size.sum()), owner


def maximal_repeats(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Maximal repeats of at least LENGTH bytes among blocks: length, and block and offset of all occurrences.

    The suffixes that begin with a whole window are sorted as far as their block goes. A stack scan over
    neighbours' common prefixes gives the intervals of the tree; an interval whose members all have the
    same byte before them is part of a longer repeat and isn't reported.
    """
    own = sizes - LENGTH + 1
    block = np.repeat(np.arange(len(sizes)), own)
    offset = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    place = starts[block] + offset
    # A suffix whose first window stands alone shares no LENGTH bytes with any other.
    windows = span_hashes(eight_bytes(data, _LONGEST), place, np.full(len(place), LENGTH), LENGTH)
    _, number, times = np.unique(windows, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[number] > 1)
    block, offset, place = block[shared], offset[shared], place[shared]
    left = sizes[block] - offset

    padded = np.concatenate([data, np.zeros(_ROW, np.uint8)])
    suffixes = padded[place[:, None] + np.arange(_ROW)]
    suffixes[np.arange(_ROW) >= left[:, None]] = 0
    order = np.lexsort((left, *suffixes.view(">u8").astype(np.uint64).T[::-1]))
    block, offset, left, suffixes = block[order], offset[order], left[order], suffixes[order]
    common = np.zeros(len(order), np.int64)
    equal = np.concatenate([suffixes[1:] == suffixes[:-1], np.zeros((max(len(order) - 1, 0), 1), bool)], axis=1)
    common[1:] = np.minimum(equal.argmin(axis=1), np.minimum(left[1:], left[:-1]))
    common[common < LENGTH] = 0
    before = np.where(offset > 0, padded[np.maximum(place[order] - 1, 0)].astype(np.int64), -1)
    changes = np.zeros(len(order), np.int64)
    changes[1:] = np.cumsum((before[1:] != before[:-1]) | (before[1:] < 0))

    stack: list[tuple[int, int]] = []  # (length, lower end) of the open intervals
    for at, here in enumerate([*common.tolist()[1:], 0], 1):
        low = at - 1
        while stack and here < stack[-1][0]:
            length, low = stack.pop()
            if changes[at - 1] > changes[low]:
                yield length, block[low:at], offset[low:at]
        if here and (not stack or here > stack[-1][0]):
            stack.append((here, low))


def mark_repeats(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per block a bit mask of the windows that also occur in a block with a smaller id."""
    marks = np.zeros(len(sizes), np.int64)
    for length, block, offset in maximal_repeats(data, starts, sizes):
        later = ids[block] > ids[block].min()
        covered = np.int64((1 << (length - LENGTH + 1)) - 1)
        np.bitwise_or.at(marks, block[later], covered << offset[later])
    return marks


# --- the steps as functions of a group of rows -------------------------------------------------------

_COUNTS = "bucket int, chunk int, anchors binary, counts binary"
_SHARED = "chunk int, anchors binary, hot binary"
_MET = "part int, chunk int, id long, block binary, anchor long, sub long"
_MARKS = "chunk int, anchor long, sub long, mask long"


def _table(schema: str, *columns) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split() for f in schema.split(",")]
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


def _planes(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys byte plane by byte plane: the upper planes hardly change and compress away."""
    return keys.view(np.uint8).reshape(-1, 8).T.tobytes()


def _keys(column: pa.ChunkedArray) -> list[np.ndarray]:
    rows = (np.frombuffer(x.as_py(), np.uint8).reshape(8, -1) for x in column)
    return [np.ascontiguousarray(x.T).view(np.uint64).ravel() for x in rows]


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def _number(group: pa.Table, name: str = "chunk") -> int:
    return group[name][0].as_py()


def _bucket(anchors: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every anchor: a range of anchors, so that a bucket's are close to one another.

    An anchor is the smallest of _WIDTH hashes, so small ones are frequent. Of all places two in _WIDTH + 1
    are anchors, and their hashes are spread like the least of half as many; ranges go by that, so that
    each bucket gets about as many anchors.
    """
    share = (anchors >> np.uint64(32)) * 2.0**-32
    return np.minimum((1 - (1 - share) ** ((_WIDTH + 1) / 2)) * buckets, buckets - 1).astype(np.int64)


def _count_anchors(buckets: int):
    def count(group: pa.Table) -> pa.Table:
        """Per hash bucket the chunk's anchors and how many different blocks it has of each."""
        chunk = Chunk(group)
        again = _repeated(chunk.runs.anchor)
        lone, more = chunk.runs.anchor[~again], chunk.runs[again]
        some, _, _ = _least((more.anchor, chunk.blocks(more)), more.doc)
        anchors, counts = np.unique(more.anchor[some], return_counts=True)
        anchors, counts = np.concatenate([lone, anchors]), np.concatenate([np.ones(len(lone), np.int64), counts])
        order = np.argsort(anchors)
        anchors, counts = anchors[order], counts[order].astype(np.uint32)
        part = _bucket(anchors, buckets)
        used, first = np.unique(part, return_index=True)
        return _table(
            _COUNTS,
            used.astype(np.int64),
            np.full(len(used), _number(group)),
            [_planes(x) for x in np.split(anchors, first[1:])] if len(used) else [],
            [x.tobytes() for x in np.split(counts, first[1:])] if len(used) else [],
        )

    return count


def _find_shared(group: pa.Table) -> pa.Table:
    """For every chunk those of its anchors that come with two or more blocks, and which of them are hot."""
    own = _keys(group["anchors"])
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in group["counts"]])
    anchors, place = np.unique(np.concatenate(own), return_inverse=True)
    total = np.bincount(place, counts)
    cuts = np.cumsum([len(x) for x in own])[:-1]
    rows = [], [], []
    for chunk, keys, times in zip(group["chunk"].to_pylist(), own, np.split(total[place], cuts)):
        shared = times > 1
        if shared.any():
            for column, value in zip(rows, (chunk, _planes(keys[shared]), (times[shared] > HOT).tobytes())):
                column.append(value)
    return _table(_SHARED, *rows)


def _parted(chunk: Chunk, shared: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which of the chunk's blocks have a shared anchor, and which a hot one."""
    if not shared.num_rows:
        return np.zeros(len(chunk.runs.anchor), bool), np.zeros(len(chunk.runs.anchor), bool)
    anchors = np.concatenate(_keys(shared["anchors"]))
    hot = np.concatenate([np.frombuffer(x.as_py(), bool) for x in shared["hot"]])
    order = np.argsort(anchors)
    anchors, hot = anchors[order], hot[order]
    at = np.minimum(np.searchsorted(anchors, chunk.runs.anchor), len(anchors) - 1)
    known = anchors[at] == chunk.runs.anchor
    return known, known & hot[at]


def _cut_out(data: np.ndarray, first: np.ndarray, end: np.ndarray, some: int = 1 << 15) -> pa.Array:
    """The bytes of every span, ``some`` spans at a time."""
    raw, parts = data.tobytes(), [pa.array([], pa.binary())]
    for low in range(0, len(first), some):
        spans = zip(first[low : low + some].tolist(), end[low : low + some].tolist())
        parts.append(pa.array([raw[a:b] for a, b in spans], pa.binary()))
    return pa.concat_arrays(parts)


def _then_give_back(job):
    """``job`` on a group or two, after which the worker keeps no memory of it."""
    if len(signature(job).parameters) == 1:

        def of_one(group: pa.Table) -> pa.Table:
            try:
                return job(group)
            finally:
                give_back()

        return of_one

    def of_two(group: pa.Table, other: pa.Table) -> pa.Table:
        try:
            return job(group, other)
        finally:
            give_back()

    return of_two


def _meet(parts: int):
    def meet(group: pa.Table, shared: pa.Table) -> pa.Table:
        """What a chunk sends: its different blocks, and different windows of hot anchors, with the smallest id.

        Blocks go by themselves; their keys are found again from their bytes.
        """
        if not group.num_rows or not shared.num_rows:
            return _table(_MET, [], [], [], [], [], [])
        chunk = Chunk(group)
        known, is_hot = _parted(chunk, shared)
        ordinary, hot = chunk.runs[known & ~is_hot], chunk.runs[is_hot]
        some, _, least = _least((ordinary.anchor, chunk.blocks(ordinary)), chunk.ids[ordinary.doc])
        blocks = _cut_out(chunk.data, ordinary.first[some], ordinary.last[some] + LENGTH)
        starts, owner = _spread(hot)
        keys = hot.anchor[owner], chunk.windows(starts)
        lone, _, first = _least(keys, chunk.ids[hot.doc[owner]])
        anchors, subs = keys[0][lone], keys[1][lone]
        route = np.concatenate([ordinary.anchor[some], mixed(anchors) ^ subs])
        return _table(
            _MET,
            (mixed(route) % np.uint64(parts)).astype(np.int64),
            np.full(len(route), _number(group)),
            np.concatenate([least, first]),
            pa.concat_arrays([blocks, pa.nulls(len(lone), pa.binary())]),
            pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(_signed(anchors))]),
            pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(_signed(subs))]),
        )

    return meet


def _resolve(group: pa.Table) -> pa.Table:
    """Marks for everything that some chunk has of an anchor, or of a hot anchor's window."""
    is_block = group["block"].is_valid()
    found = [_resolve_blocks(group.filter(is_block)), _resolve_windows(group.filter(pc.invert(is_block)))]
    return pa.concat_tables([_table(_MARKS, *columns) for columns in found])


def _resolve_windows(group: pa.Table) -> tuple[np.ndarray, ...]:
    anchor, sub, ids = (group[n].to_numpy() for n in ("anchor", "sub", "id"))
    _, number, least = _least((anchor, sub), ids)
    hit = np.flatnonzero(ids > least[number])
    return group["chunk"].to_numpy()[hit], anchor[hit], sub[hit], np.full(len(hit), -1)


def _resolve_blocks(group: pa.Table) -> tuple[np.ndarray, ...]:
    ids, blocks = group["id"].to_numpy(), group["block"].to_pylist()
    sizes = np.array([len(b) for b in blocks], np.int64)
    data, ends = np.frombuffer(b"".join(blocks), np.uint8), np.cumsum(sizes)
    # All windows of a block have one anchor; a slice's end may have cut a block in two.
    whole = runs(data, ends)
    anchor = whole.anchor[np.unique(whole.doc, return_index=True)[1]]
    sub = span_hashes(eight_bytes(data, _LONGEST), ends - sizes, sizes, _LONGEST)
    some, number, least = _least((anchor, sub), ids)
    # Only anchors with several different blocks need the suffix array.
    several = _repeated(anchor[some])
    marks = np.zeros(len(some), np.int64)
    if several.any():
        chosen = some[several]
        part = np.frombuffer(b"".join(blocks[i] for i in chosen.tolist()), np.uint8)
        marks[several] = mark_repeats(part, np.cumsum(sizes[chosen]) - sizes[chosen], sizes[chosen], least[several])
    # A chunk whose own smallest document isn't the smallest of all loses the whole block.
    mask = np.where(ids > least[number], np.int64(-1), marks[number])
    hit = np.flatnonzero(mask)
    return group["chunk"].to_numpy()[hit], _signed(anchor[hit]), _signed(sub[hit]), mask[hit]


def _marked(chunk: Chunk, chosen: Runs, hashes: np.ndarray, marks: pa.Table) -> np.ndarray:
    """Window starts of the chosen blocks (or, as blocks of one window, windows) that are marked."""
    _, number, least = _least((chosen.anchor, hashes), ids := chunk.ids[chosen.doc])
    mask = np.where(ids > least[number], np.int64(-1), np.int64(0))
    if marks.num_rows:
        keys = mixed(marks["anchor"].to_numpy().view(np.uint64)) ^ marks["sub"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys, given = keys[order], marks["mask"].to_numpy()[order]
        own = mixed(chosen.anchor) ^ hashes
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        mask |= np.where(keys[at] == own, given[at], 0)
    # Only blocks with a mark are spread out: mostly a small part of them.
    some = np.flatnonzero(mask)
    chosen, mask = chosen[some], mask[some]
    starts, owner = _spread(chosen)
    return starts[(mask[owner] >> (starts - chosen.first[owner])) & 1 == 1]


def _joined_spans(marked: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that marked windows cover, as spans in order that neither touch nor cross a text's end."""
    starts = np.unique(marked)
    if not len(starts):
        return starts, starts
    doc = np.searchsorted(ends, starts, side="right")
    apart = (starts[1:] - starts[:-1] > LENGTH) | (doc[1:] != doc[:-1])
    return starts[np.append(True, apart)], starts[np.append(apart, True)] + LENGTH


def _remover(with_text: bool):
    def remove(group: pa.Table, told: pa.Table) -> pa.Table:
        chunk = Chunk(group)
        is_mark = told["anchors"].is_null()
        marks = told.filter(is_mark)
        known, is_hot = _parted(chunk, told.filter(pc.invert(is_mark)))
        # Blocks that no other chunk has may still repeat within this one.
        ordinary, hot = chunk.runs[(known | _repeated(chunk.runs.anchor)) & ~is_hot], chunk.runs[is_hot]
        starts, owner = _spread(hot)
        windows = Runs(starts, starts, starts, hot.doc[owner])
        windows.anchor = hot.anchor[owner]
        marked = np.concatenate(
            [
                _marked(chunk, ordinary, chunk.blocks(ordinary), marks),
                _marked(chunk, windows, chunk.windows(starts), marks),
            ]
        )
        lows, highs = _joined_spans(marked, chunk.ends)
        begins = np.concatenate([[0], chunk.ends[:-1]])
        edges = np.searchsorted(lows, np.append(begins, chunk.ends[-1:])).tolist()
        raw = chunk.data.tobytes()
        out = {n: [] for n in ("n_bytes", "n_removed", "kept_sha256", "starts", "lengths", "text")}
        for low, high, a, b in zip(begins.tolist(), chunk.ends.tolist(), edges, edges[1:]):
            first, end = lows[a:b] - low, highs[a:b] - low
            whole = raw[low:high]
            rest = b"".join(whole[a:b] for a, b in zip([0, *end.tolist()], [*first.tolist(), len(whole)]))
            out["n_bytes"].append(len(whole))
            out["n_removed"].append(len(whole) - len(rest))
            out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
            out["starts"].append(first.tolist())
            out["lengths"].append((end - first).tolist())
            out["text"].append(_whole_characters(whole, first, end) if with_text else None)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
        return pa.table({"kept": group["kept"], **{n: pa.array(out[n], k) for n, k in zip(out, kinds)}})

    return remove


def _whole_characters(whole: bytes, first: np.ndarray, end: np.ndarray) -> str:
    """The text without the spans; a character that a span covers in part stays."""
    parts, at = [], 0
    for low, high in zip(first.tolist(), end.tolist()):
        while low < high and whole[low] & 0xC0 == 0x80:  # begins within a character
            low += 1
        while high > low and high < len(whole) and whole[high] & 0xC0 == 0x80:  # ends within one
            high -= 1
        parts.append(whole[at:low])
        at = high
    return b"".join([*parts, whole[at:]]).decode()


# --- the job ----------------------------------------------------------------------------------------------


def find_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str | Column] = ("doc_id",),
    with_text: bool = False,
) -> DataFrame:
    """Per row ``kept`` (a struct of the columns ``keep``) and what goes of its text.

    n_bytes, n_removed, ``starts`` and ``lengths`` (the maximal removed runs, in bytes), kept_sha256 (of
    the remaining bytes), and ``text`` without the runs if asked for; a character that a run covers only
    in part stays in that text. A null text is empty. A row without key comes after all others. Rows
    with equal keys don't remove anything from each other. Matches never cross rows.

    Texts are dealt into chunks by their hash, so that copies meet at once (``COPIES`` of a text at most,
    more are dealt over several chunks), shuffled once, and read three times from that shuffle: to count
    anchors, to send blocks, to cut. Anchors travel as arrays, one for each chunk and hash bucket.
    """
    rows = df.select(
        F.struct(*[F.col(c) if isinstance(c, str) else c for c in keep]).alias("kept"),
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("digest", F.xxhash64("text"))
    by_text = materialise(
        rows.groupBy("digest").agg(F.count("*").alias("copies"), F.sum(F.octet_length("text")).alias("bytes")), "texts"
    )
    size = by_text.agg(F.sum("bytes")).head()[0] or 0
    chunks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // CHUNK_BYTES))
    hot = materialise(by_text.where(F.col("copies") > COPIES).select("digest", "copies"), "hot-texts")
    turn = F.pmod(F.monotonically_increasing_id(), F.ceil(F.col("copies") / COPIES))
    salt = F.when(F.col("copies").isNotNull(), turn).otherwise(0)
    chunk = F.pmod(F.xxhash64("digest", salt), F.lit(chunks)).cast("int").alias("chunk")
    dealt = rows.join(hot, "digest", "left").select("kept", "id", "text", chunk)
    by_chunk = dealt.groupBy("chunk")
    counted = by_chunk.applyInArrow(_then_give_back(_count_anchors(chunks)), _COUNTS)
    shared = counted.groupBy("bucket").applyInArrow(_find_shared, _SHARED)
    met = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_then_give_back(_meet(chunks)), _MET)
    marks = met.groupBy("part").applyInArrow(_then_give_back(_resolve), _MARKS)
    told = shared.unionByName(marks, allowMissingColumns=True)
    long_list = T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("kept", rows.schema["kept"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("starts", long_list),
            T.StructField("lengths", long_list),
            T.StructField("text", T.StringType()),
        ]
    )
    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_then_give_back(_remover(with_text)), schema)


def without_repeats(documents: DataFrame) -> DataFrame:
    """All documents, their texts without the repeats and n_chars, if there, after it; else as they were.

    A text of which nothing is left stays as an empty text; a null text stays null.
    """
    # The text travels once; beside it only whether there was one.
    keep = [F.col(c).isNotNull().alias(c) if c == "text" else F.col(c) for c in documents.columns]
    cut = find_repeats(documents, keep=keep, with_text=True)
    text = F.when(F.col("kept.text"), F.col("text"))
    new = {"text": text}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length(text).cast(documents.schema["n_chars"].dataType)
    return cut.select(*[new.get(c, F.col("kept")[c]).alias(c) for c in documents.columns])


def op6_common_prefix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes of all documents; see :func:`find_repeats`."""
    found = find_repeats(table(spark, sf_dir, "documents"))
    return found.select("kept.doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256")

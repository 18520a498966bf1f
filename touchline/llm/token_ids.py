"""Token ids of whole texts, with the tokenizer asked once for each part of a word.

The tokenizer drops white space, lower-cases, and cuts at the borders between letters, single digits
and other marks (and before an English ending such as 's) before it merges. So the ids of a text are
those of its parts in a row. Parts are found and hashed for many texts at once with numpy; only parts
that a worker meets for the first time go through the tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

from touchline.llm.words import eight_bytes, span_hashes

# Texts of these characters alone are cut into parts here: no composition changes them, and
# lower-casing stays among them. All other texts go through the tokenizer as they are.
_PLAIN = re.compile("[ \t-\r!-~À-ÖØ-öø-ÿ]*")
# Parts remembered by a worker; beyond that it starts anew. Bounds memory only.
_REMEMBERED = 1_500_000
# Longer parts are hashed one by one.
_LONG = 64
_SPACE, _LETTER, _DIGIT, _MARK = range(4)


def portions(column: pa.Array, characters: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """A column's texts (null: empty) some at a time, each portion with the row it begins at."""
    at, texts, size = 0, [], 0
    for value in column:
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= characters:
            yield at, texts
            at, texts, size = at + len(texts), [], 0
    yield at, texts


def _kinds() -> np.ndarray:
    kinds = np.full(256, _MARK, np.uint8)
    for kind, runs in (
        (_SPACE, [(0x20, 0x20), (0x09, 0x0D)]),
        (_LETTER, [(0x61, 0x7A), (0xDF, 0xF6), (0xF8, 0xFF)]),
        (_DIGIT, [(0x30, 0x39)]),
    ):
        for low, high in runs:
            kinds[low : high + 1] = kind
    return kinds


_KIND = _kinds()


def part_borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every part in lower-cased Latin-1 bytes that end with white space."""
    kind = _KIND[data]
    border = np.empty(len(data), bool)
    border[0] = True
    np.not_equal(kind[1:], kind[:-1], out=border[1:])
    border |= kind == _DIGIT
    # An apostrophe that begins a run of marks and stands right before a letter may begin an ending.
    quote = np.flatnonzero(data == ord("'"))
    quote = quote[border[quote]]
    quote = quote[kind[np.minimum(quote + 1, len(data) - 1)] == _LETTER]
    if len(quote):
        first, second = data[quote + 1], data[np.minimum(quote + 2, len(data) - 1)]
        one = np.isin(first, np.frombuffer(b"stmd", np.uint8))
        two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
        two |= (first == ord("l")) & (second == ord("l"))
        border[quote[one | two] + 1] = False
        for at in (quote[one] + 2, quote[two & ~one] + 3):
            border[at] = True
    edges = np.flatnonzero(border)
    ends = np.append(edges[1:], len(data))
    real = kind[edges] != _SPACE
    return edges[real], ends[real]


def part_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every part."""
    sizes = ends - starts
    h = span_hashes(eight_bytes(data, _LONG), starts, np.minimum(sizes, _LONG), _LONG)
    for at in np.flatnonzero(sizes > _LONG):
        h[at] = xxhash.xxh3_64_intdigest(data[starts[at] : ends[at]].tobytes())
    return h


class TokenIds:
    """The ids of texts; ``path`` names the tokenizer's file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known, self.row = np.empty(0, np.uint64), np.empty(0, np.int64)  # hashes in order, and their rows
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.first, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, places: np.ndarray, parts: list[str]) -> None:
        ids = self._encode(parts)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(size.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        self.known = np.insert(self.known, places, hashes)
        self.row = np.insert(self.row, places, np.arange(len(self.size), len(self.size) + len(ids)))
        self.first = np.append(self.first, self.used + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.used += total

    def of(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of every text, as unsigned 32-bit numbers."""
        plain = [_PLAIN.fullmatch(text) is not None and "<|" not in text for text in texts]
        some = iter(self._of_plain([text for text, p in zip(texts, plain) if p]))
        rest = iter(self._encode([text for text, p in zip(texts, plain) if not p]))
        return [next(some) if p else np.array(next(rest), np.uint32) for p in plain]

    def _of_plain(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if len(self.known) > _REMEMBERED:
            self._forget()
        data = np.frombuffer(("\n".join(texts) + "\n").lower().encode("latin-1"), np.uint8)
        starts, ends = part_borders(data)
        hashes, where, place = np.unique(part_hashes(data, starts, ends), return_index=True, return_inverse=True)
        spot = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != hashes[inside]
        if new.any():
            whole = data.tobytes()
            parts = [whole[starts[i] : ends[i]].decode("latin-1") for i in where[new].tolist()]
            self._learn(hashes[new], spot[new], parts)
            spot = np.searchsorted(self.known, hashes)
        row = self.row[spot][place]
        size = self.size[row]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.first[row] - upto[:-1], size) + np.arange(upto[-1])]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        cuts = upto[np.searchsorted(starts, np.cumsum(lengths))]
        return np.split(ids, cuts[:-1])


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One for each worker process: later tasks know the parts that earlier ones met."""
    return TokenIds(path)

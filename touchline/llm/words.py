"""Word hashes of texts, for operators that work inside a task on Arrow batches."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash

# Words remembered at once by one worker; beyond that it starts anew. Bounds memory only.
_REMEMBERED = 400_000


def give_back() -> None:
    """Return memory that is free to the system: a worker that has done a large group may wait for long.

    Where the C library can't be asked, only Arrow's share is returned.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


class WordHashes(dict):
    """64-bit hash by word, computed once for each word a worker meets."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of multiplications and shifts)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_TAIL = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def eight_bytes(data: np.ndarray, longest: int = 8) -> np.ndarray:
    """The eight bytes from every place on as one number, up to ``longest`` bytes beyond the end (zeros)."""
    padded = np.concatenate([data, np.zeros(longest + 8, np.uint8)])
    return np.ndarray(len(data) + longest, "<u8", padded, strides=(1,))


def span_hashes(eight: np.ndarray, starts: np.ndarray, sizes: np.ndarray, longest: int) -> np.ndarray:
    """A 64-bit hash of every span of at most ``longest`` bytes; ``eight`` as above."""
    h = mixed(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    active = np.arange(len(starts))
    for step in range(0, longest, 8):
        active = active[sizes[active] > step]
        if not len(active):
            break
        left = np.minimum(sizes[active] - step, 8)
        h[active] = mixed(h[active] ^ (eight[starts[active] + step] & _TAIL[left]))
    return h


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` words; order counts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for at in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[at : at + n]
    return mixed(h)

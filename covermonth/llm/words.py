"""Words of whole texts and their hashes, batch by batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Words remembered in one task. A full memory is emptied: only time is lost.
REMEMBERED = 50_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def words(text: str | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text with A-Z in lower case, as UTF-8; none of a null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix64 finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; of a shorter text, its one run."""
    if not len(hashes):
        return hashes
    runs = max(1, len(hashes) - size + 1)
    value = np.zeros(runs, np.uint64)
    for k in range(min(size, len(hashes))):
        value = mix(value + hashes[k:k + runs] * _MIX + np.uint64(k + 1))
    return np.unique(value)


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64), pa.int64())


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A list column of 64-bit values from its flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), longs(values))

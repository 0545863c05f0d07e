"""Hashes of words and word windows over Arrow slices, by array arithmetic.

A word is a run of anything but ASCII white space. A word's hash is a polynomial
over its bytes (through a table of random values) modulo 2**64, mixed; a
window's is a polynomial over its words' hashes. Both come from prefix sums, so
a window costs the same whatever its length. Words of more than 64 bytes, for
which such polynomials are weak, are hashed with XXH64 instead.
"""

import numpy as np
import pyarrow as pa
import xxhash

from jobuse.llm.common import worker_state

SLICE_BYTES = 2 << 20
BYTE_STEP, WORD_STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)    # odd, so they have inverses
LONG_WORD = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _powers(step: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of an odd number and of its inverse, kept by the worker."""
    kept = worker_state().__dict__.setdefault("powers", {})
    if len(kept.get(step, ((), ()))[0]) <= n:
        size = max(1 << 16, 1 << n.bit_length())
        inverse = np.uint64(pow(int(step), -1, 1 << 64))
        kept[step] = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, s, np.uint64))]) for s in (step, inverse))
    return kept[step]


class Sums:
    """Prefix sums of hashes; gives the hash of any run of them."""

    def __init__(self, values: np.ndarray, step: np.uint64):
        self.up, self.down = _powers(step, len(values))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(values * self.up[:len(values)], dtype=np.uint64)])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def _buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a ``large_string`` array, and where each string begins (and the last ends)."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset: strings.offset + len(strings) + 1]
    buffer = strings.buffers()[2]
    data = (np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8))[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


def _byte_table() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * BYTE_STEP)


def string_hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each string; for strings of no more than ``LONG_WORD`` bytes."""
    data, offsets = _buffers(strings)
    values = _byte_table()[data]
    return tuple(Sums(values, step).runs(offsets[:-1], offsets[1:]) for step in (BYTE_STEP, WORD_STEP))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (``large_string``), flat, and the number of words of each."""
    data, offsets = _buffers(texts)
    inside = np.concatenate([[False], (data != 32) & ((data < 9) | (data > 13)), [False]])
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True                                             # a word ends with its text
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    hashes = Sums(_byte_table()[data], BYTE_STEP).runs(start, end)
    for k in np.flatnonzero(end - start > LONG_WORD):
        hashes[k] = xxhash.xxh64_intdigest(data[start[k]: end[k]].tobytes(), 1)
    return hashes, np.diff(np.searchsorted(start, offsets))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if width > size else values

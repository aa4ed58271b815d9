"""Words of many texts at once, as arrays over their UTF-8 bytes.

The tasks that look at every word work on whole Arrow batches: one flag per byte, one offset
per word. Batches are cut into pieces of a few megabytes, so the memory of a task follows the
piece (or the longest single text), not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2_000_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE

# Digits, letters after lower-casing, and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """``buffer`` holds every word followed by one space; word i starts at ``at[i]`` and has
    ``length[i]`` bytes; text t has the words ``first[t]`` to ``first[t + 1]``."""

    buffer: np.ndarray
    at: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """One 64-bit value per word, a function of its bytes."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        place = np.arange(len(self.buffer)) - np.repeat(self.at, self.length + 1)
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE, np.uint64))
        terms = _BYTE[self.buffer] * powers[place]
        return mix(np.add.reduceat(terms, self.at))

    def as_binary(self) -> pa.Array:
        """The words as an Arrow array, without their spaces."""
        keep = np.ones(len(self.buffer), bool)
        keep[self.at + self.length] = False
        offsets = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int32)
        data = np.ascontiguousarray(self.buffer[keep])
        return pa.Array.from_buffers(
            pa.binary(), len(self.at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        )


def split_words(texts: pa.Array, table: np.ndarray, lower: bool) -> Words:
    """Words are runs of bytes that ``table`` accepts; null texts have none."""
    ended = pc.binary_join_element_wise(
        pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()),
        pa.scalar("\n", pa.large_string()),
    )
    offsets = np.frombuffer(ended.buffers()[1], np.int64)[
        ended.offset : ended.offset + len(ended) + 1
    ]
    data = np.frombuffer(ended.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    inside = table[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside]).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    length = ends - starts
    inside[ends] = True
    buffer = data[inside]
    at = np.concatenate([[0], np.cumsum(length + 1)[:-1]]) if len(length) else length
    if len(at):
        buffer[at + length] = 0x20
    return Words(buffer, at.astype(np.int64), length, np.searchsorted(starts, offsets))


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each; a longer text is one slice."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    begin = 0
    while begin < batch.num_rows:
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)


def binary_slices(buffer: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Byte ranges of a buffer as an Arrow binary array."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    data = np.ascontiguousarray(buffer[ranges(starts, counts)])
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """The value of every n consecutive items, at the first of them."""
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = (total * _BASE) + hashes[k : k + size]
    return mix(total + np.uint64(n))


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))

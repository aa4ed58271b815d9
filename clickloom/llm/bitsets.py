"""Membership in a large set of hashes by a bit set of fixed size.

A hash is in the set if its top bits are. Hashes that share those bits with a member pass as
well, so a bit set may only be used to leave out what a later, exact step would drop anyway.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# 8 MB, whatever the size of the input.
FILTER_BITS = 26


def in_set(flags: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    bit = hashes >> np.uint64(64 - (8 * len(flags)).bit_length() + 1)
    return ((flags[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1) > 0


def _bit_parts(bits: int, parts_bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One slice of the bit set for every part of the hashes that comes by."""
    sets: dict[int, np.ndarray] = {}
    for batch in batches:
        bit = batch.column("hash").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
        part = (bit >> np.uint64(bits - parts_bits)).astype(np.int64)
        place = (bit & np.uint64((1 << (bits - parts_bits)) - 1)).astype(np.int64)
        for p in np.unique(part).tolist():
            flags = sets.setdefault(p, np.zeros(1 << (bits - parts_bits), bool))
            flags[place[part == p]] = True
    for p, flags in sets.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([p], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()])],
            names=["part", "flags"],
        )


def bit_set(hashes: DataFrame, bits: int = FILTER_BITS, parts_bits: int = 6) -> bytes:
    """The top ``bits`` bits of every value in ``hash`` as a set of bits; built by part in the
    tasks."""
    part = F.shiftrightunsigned("hash", 64 - parts_bits)
    dealt = hashes.select("hash").repartition(1 << parts_bits, part)
    built = dealt.mapInArrow(lambda b: _bit_parts(bits, parts_bits, b), "part int, flags binary")
    out = bytearray(1 << (bits - 3))
    step = len(out) >> parts_bits
    for p, flags in built.toLocalIterator():
        out[p * step : (p + 1) * step] = flags
    return bytes(out)

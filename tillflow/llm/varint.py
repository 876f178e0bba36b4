"""Lists of rising whole numbers as differences in variable-length bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(positions: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rising numbers of consecutive lists (``counts`` each) as one binary value per list."""
    heads = np.cumsum(counts) - counts
    steps = np.diff(positions, prepend=0)
    steps[heads[counts > 0]] = positions[heads[counts > 0]]
    width = np.ones(len(steps), np.int64)
    largest = int(steps.max()) if len(steps) else 0
    for bits in range(7, largest.bit_length(), 7):
        width += steps >= 1 << bits
    ends = np.cumsum(width)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at, left, more = ends - width, steps, width
    while len(at):
        out[at] = left & 127 | (more > 1) << 7
        on = more > 1
        at, left, more = at[on] + 1, left[on] >> 7, more[on] - 1
    bounds = np.concatenate([[0], ends])[np.append(heads, len(steps))].astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def unpacked(value: bytes | None) -> np.ndarray:
    data = np.frombuffer(value or b"", np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], data[:-1] < 128]))
    sizes = np.diff(np.append(begins, len(data)))
    place = np.arange(len(data)) - np.repeat(begins, sizes)
    return np.cumsum(np.add.reduceat((data & 127).astype(np.int64) << 7 * place, begins))

"""Words of Arrow text columns as numpy arrays, a batch of documents at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes that belong to words.  Bytes from 0x80 on are parts of characters beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

SLICE_BYTES = 6 << 20


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text, one row at least."""
    offsets = bounds(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def bounds(texts: pa.Array) -> np.ndarray:
    """Byte offsets of the texts in their shared buffer; null texts have no bytes."""
    width = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if not len(texts):
        return np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], width)
    return offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins in them."""
    offsets = bounds(texts)
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch; word ``i`` of row ``r`` has the number ``first[r] + i``."""

    data: np.ndarray  # bytes of the words, one after the other
    at: np.ndarray  # where each word begins in data, and the end
    first: np.ndarray  # first word of each row, and the end
    spans: tuple[np.ndarray, np.ndarray] | None = None  # begin and end of each word in the bytes of all texts

    def __len__(self) -> int:
        return len(self.at) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def strings(self) -> pa.Array:
        at = self.at.astype(np.int32)
        return pa.StringArray.from_buffers(len(self), pa.py_buffer(at), pa.py_buffer(self.data))

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Number of each word in the distinct words, and the distinct words."""
        coded = self.strings().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each; begin and end of each word."""
        count = np.arange(len(self))
        out = np.full(len(self.data) + len(self), 32, np.uint8)
        out[np.arange(len(self.data)) + np.repeat(count, np.diff(self.at))] = self.data
        return out.tobytes(), self.at[:-1] + count, self.at[1:] + count


def words(texts: pa.Array, member: np.ndarray, lower: bool = True) -> Words:
    """Longest runs of ``member`` bytes; no run passes from one text into the next."""
    data, offsets = raw(texts)
    inside = member[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(stop - start, out=at[1:])
    kept = data[inside]
    return Words(LOWER[kept] if lower else kept, at, np.searchsorted(start, offsets), (start, stop))

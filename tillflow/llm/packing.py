"""Sum-of-squares packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.bpe import token_ids
from tillflow.llm.text import slices
from tillflow.llm.work import arrow_map
from tillflow.sources.staging import staged

CAPACITY = 2048
SHARE = 32_768  # pieces that one task packs together, on average
HELD_BYTES = 32 << 20  # and no more bytes at a time, if it holds the ids as well
ROW = "row__"  # number of a staged piece


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order, and the final gap of each bin.

    With N[g] bins open at gap g, a length s goes into the open bin for which the sum of N[g]²
    ends smallest: a bin of gap g changes it by 2 (N[g - s] - N[g]) + 2, one that it fills by
    1 - 2 N[s].  Of equal places the smallest gap wins.  A bin is opened only for what fits in
    none, which on decreasing lengths stays within a bin or two of the least number.
    """
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, np.int64)
    bins, offsets, gaps = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, s in enumerate(lengths.tolist()):
        fitting = np.flatnonzero(n[s:capacity]) + s
        if len(fitting):
            after = n[fitting - s]
            after[fitting == s] = 0
            gap = int(fitting[np.argmin(2 * (after - n[fitting]) + (fitting != s))])
            bins[i] = open_at[gap].pop()
            n[gap] -= 1
        else:
            gap, bins[i] = capacity, len(gaps)
            gaps.append(capacity)
        offsets[i], left = capacity - gap, gap - s
        gaps[bins[i]] = left
        if left:
            open_at[left].append(int(bins[i]))
            n[left] += 1
    return bins, offsets, np.array(gaps, np.int64)


def _cut(batch: pa.RecordBatch, path: str, capacity: int, with_ids: bool, end: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batch):
        ids, counts = token_ids(part.column("text"), path)
        total = counts + 1
        begin = np.cumsum(total) - total
        stream = np.full(int(total.sum()), end, np.uint32)
        stream[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        pieces = -(-total // capacity)
        row = np.repeat(np.arange(len(total)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * capacity
        length = np.minimum(total[row] - start, capacity)
        at = begin[row] + start
        little = stream.astype("<u4")
        sums = [zlib.crc32(little[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
        columns = {
            "doc_id": part.column("doc_id").take(pa.array(row)),
            "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start),
            "length": pa.array(length),
            "ids_crc32": pa.array(sums, pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(at, len(stream)), pa.int32()), pa.array(stream.view(np.int32)))
        yield pa.RecordBatch.from_pydict(columns)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, end: int = 0) -> DataFrame:
    """Token ids of each text and then ``end``, cut into pieces of ``capacity``; the last may be shorter.

    Columns: doc_id, piece (from 0), start, length, ids_crc32 (of the ids as little-endian
    unsigned 32-bit numbers) and, on request, ids.  Null and empty texts have one piece of one
    token; repeated rows have pieces each; ids may be null.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    cut = partial(_cut, path=path, capacity=capacity, with_ids=with_ids, end=end)
    return arrow_map(docs.select("doc_id", "text"), cut, schema + ", ids array<int>" * with_ids)


def _packed(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    partition, used = TaskContext.get().partitionId(), 0

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal used
        rows = pa.Table.from_batches(held)
        order = [("length", "descending"), *((n, "ascending") for n in ("doc_id", "piece", "ids_crc32"))]
        rows = rows.sort_by(order)
        bins, offsets, gaps = place(rows.column("length").to_numpy(), capacity)
        numbers = (partition << 36) + used + bins
        used += len(gaps)
        full = rows.append_column("sequence_id", pa.array(numbers)).append_column("offset", pa.array(offsets))
        yield from full.to_batches(max_chunksize=4096)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 4 * SHARE or sum(b.nbytes for b in held) >= HELD_BYTES:
            yield from packed(held)
            held = []
    if held:
        yield from packed(held)


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (see ``pieces``; written tables are best).

    Pieces are dealt by hash (of ``ROW`` too, if the table has it, so that repeated rows go to
    many tasks) to tasks of about ``SHARE`` rows, and each task packs its own in
    decreasing order of length; so a few sequences in ten thousand are less than full for the
    dealing, whatever the size of the input.  A task never holds more than four shares or
    ``HELD_BYTES``.
    """
    columns = [c for c in cut.columns if c != ROW]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields if f.name != ROW)
    shares = max(1, -(-cut.count() // SHARE))
    keys = ["doc_id", "piece", "ids_crc32", *({ROW} & set(cut.columns))]
    dealt = cut.repartition(shares, F.xxhash64(*keys)).select(*columns)
    return dealt.mapInArrow(partial(_packed, capacity=capacity), f"{types}, sequence_id bigint, offset bigint")


def packed_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in a sequence; an empty table gives no rows."""
    cut = pieces(docs, path, capacity, with_ids).withColumn(ROW, F.monotonically_increasing_id())
    return packed(staged(cut, "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed ids of each sequence, from placed pieces with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))

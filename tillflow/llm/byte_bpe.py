"""Byte-level BPE by a segment tree of pair ranks over the byte positions, and back to bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillflow.llm.bpe import gathered
from tillflow.llm.text import raw, slices
from tillflow.llm.work import arrow_map

HELD = 1 << 17  # pre-tokens held as strings at a time
SLICE_BYTES = 2 << 20  # of text at a time, one text at least
TREE_CELLS = 1 << 18  # of the segment trees that are worked on together
WIDE = 512  # bytes from which a pre-token gets a tree of its own
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """A byte-level vocabulary: a token's id is its rank, and two tokens merge if their bytes together are one."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.rank_of = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.count = max(self.rank_of.values()) + 1
        by_rank = [b""] * self.count
        for token, rank in self.rank_of.items():
            by_rank[rank] = token
        self.by_rank = by_rank
        self.sizes = np.array([len(t) for t in by_rank], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.of_byte = np.array([self.rank_of[bytes([b])] for b in range(256)], np.int32)
        halves = [
            (self.rank_of[token[:i]] * self.count + self.rank_of[token[i:]], rank)
            for token, rank in self.rank_of.items()
            for i in range(1, len(token))
            if token[:i] in self.rank_of and token[i:] in self.rank_of
        ]
        self.bits = (4 * len(halves)).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.found = np.full(1 << self.bits, self.count, np.int32)
        pairs = np.array(halves, np.int64).reshape(-1, 2)
        for (key, rank), slot in zip(halves, self._slots(pairs[:, 0]).tolist(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.found[slot] = key, rank

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, ``count`` where they don't merge."""
        keys = left.astype(np.int64) * self.count + right
        slots = self._slots(keys)
        out = self.found[slots]
        again = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] >= 0))
        while len(again):
            slots[again] = (slots[again] + 1) % len(self.keys)
            out[again] = self.found[slots[again]]
            again = again[(self.keys[slots[again]] != keys[again]) & (self.keys[slots[again]] >= 0)]
        return out

    def _trees(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Merge pre-tokens of up to ``width`` bytes, one a row of ``tokens``; marks the places that stay.

        Row r's segment tree has a leaf for each byte position: the rank of the pair that begins
        there, above the position itself, so that the root is the lowest rank at its leftmost
        place.  In a round each row that can still merge does its one next merge and renews the
        leaves of the merged place, of the swallowed one and of the live one before.
        """
        rows, width = tokens.shape
        deep = width.bit_length() - 1
        place = np.arange(width)
        never = self.count << deep
        tree = np.full((rows, 2 * width), never, np.int64)
        inside = place[:-1] < lengths[:, None] - 1
        ranks = self.pairs(tokens[:, :-1][inside], tokens[:, 1:][inside]).astype(np.int64)
        leaves = tree[:, width : 2 * width - 1]
        leaves[inside] = (ranks << deep) + np.nonzero(inside)[1]
        for level in range(deep - 1, -1, -1):
            low, high = 1 << level, 2 << level
            tree[:, low:high] = np.minimum(tree[:, 2 * low : 2 * high : 2], tree[:, 2 * low + 1 : 2 * high : 2])
        after = np.minimum(place + 1, lengths[:, None]).astype(np.int32)
        before = np.broadcast_to(place - 1, tokens.shape).astype(np.int32)
        stays = place < lengths[:, None]
        tree, after, before, flat, alive = tree.ravel(), after.ravel(), before.ravel(), tokens.ravel(), stays.ravel()

        def renew(row: np.ndarray, leaf: np.ndarray, rank: np.ndarray | int) -> None:
            base, node = row * (2 * width), leaf + width
            tree[base + node] = np.minimum((np.asarray(rank, np.int64) << deep) + leaf, never)
            for _ in range(deep):
                node = node >> 1
                tree[base + node] = np.minimum(tree[base + 2 * node], tree[base + 2 * node + 1])

        row = np.arange(rows)
        while True:
            root = tree[row * (2 * width) + 1]
            row, root = row[root < never], root[root < never]
            if not len(row):
                return stays
            at, base = root & (width - 1), row * width
            gone = after[base + at]
            flat[base + at] = root >> deep
            follower = after[base + gone]
            after[base + at] = follower
            alive[base + gone] = False
            renew(row, gone, self.count)
            more = follower < lengths[row]
            before[base[more] + follower[more]] = at[more]
            rank = np.full(len(row), self.count, np.int64)
            rank[more] = self.pairs(flat[base[more] + at[more]], flat[base[more] + follower[more]])
            renew(row, at, rank)
            former = before[base + at]
            more = former >= 0
            renew(row[more], former[more], self.pairs(flat[base[more] + former[more]], flat[base[more] + at[more]]))

    def _tree(self, data: bytes) -> list[int]:
        """The same for one wide pre-token, without the cost of arrays for each merge."""
        size = len(data)
        width = 1 << (size - 1).bit_length()
        never = self.count * width
        tokens: list[bytes] = [data[i : i + 1] for i in range(size)]
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        tree = [never] * (2 * width)
        for i in range(size - 1):
            rank = self.rank_of.get(data[i : i + 2])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def renew(leaf: int) -> None:
            rank = self.rank_of.get(tokens[leaf] + tokens[after[leaf]]) if tokens[leaf] and after[leaf] < size else None
            node = width + leaf
            tree[node] = never if rank is None else rank * width + leaf
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        while tree[1] < never:
            at = tree[1] % width
            gone = after[at]
            tokens[at] += tokens[gone]
            tokens[gone] = b""
            after[at] = after[gone]
            if after[at] < size:
                before[after[at]] = at
            for leaf in (gone, at, before[at]):
                if leaf >= 0:
                    renew(leaf)
        return [self.rank_of[t] for t in tokens if t]

    def encoded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens ``data[offsets[i]:offsets[i + 1]]`` one after the other, and how many each has."""
        lengths = np.diff(offsets)
        tokens, stays = self.of_byte[data], np.ones(len(data), bool)
        width, least = 2, 1
        while width <= WIDE:
            members = np.flatnonzero((lengths > least) & (lengths <= width))
            share = max(TREE_CELLS // (2 * width), 1)
            for low in range(0, len(members), share):
                part = members[low : low + share]
                at = offsets[part][:, None] + np.arange(width)
                inside = np.arange(width) < lengths[part][:, None]
                rows = np.where(inside, tokens[np.where(inside, at, 0)], 0)
                kept = self._trees(rows, lengths[part])
                tokens[at[inside]], stays[at[inside]] = rows[inside], kept[inside]
            width, least = 2 * width, width
        for i in np.flatnonzero(lengths > WIDE).tolist():
            ids = self._tree(data[offsets[i] : offsets[i + 1]].tobytes())
            tokens[offsets[i] : offsets[i] + len(ids)] = ids
            stays[offsets[i] + len(ids) : offsets[i + 1]] = False
        total = np.concatenate([[0], np.cumsum(stays)])
        return tokens[stays], np.diff(total[offsets])

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and how many bytes each run of ``counts`` ids has."""
        total = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        ends = np.cumsum(counts)
        return gathered(self.bytes, self.starts, self.sizes, ids), total[ends] - total[ends - counts]


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def token_ids(texts: pa.Array, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each has; null texts have none.

    Matches of ``pattern`` are cut out and encoded each by itself, equal ones once for every
    ``HELD`` of them.
    """
    vocabulary, cut = ranks(path), _compiled(pattern)
    found = ((row, match[0]) for row, text in enumerate(texts.to_pylist()) if text for match in cut.finditer(text))
    ids, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
    while part := list(islice(found, HELD)):
        rows, strings = zip(*part, strict=True)
        coded = pa.array(strings, pa.string()).dictionary_encode()
        values, sizes = vocabulary.encoded(*raw(coded.dictionary))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ids.append(gathered(values, np.cumsum(sizes) - sizes, sizes, codes))
        counts += np.bincount(rows, sizes[codes], len(texts)).astype(np.int64)
    return np.concatenate(ids), counts


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    values = np.split(data, np.cumsum(sizes)[:-1]) if len(sizes) else []
    return pa.array((v.tobytes() for v in values), pa.binary(), size=len(values))


def _encoded(batch: pa.RecordBatch, path: str, pattern: str, decode: bool) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, limit=SLICE_BYTES):
        ids, counts = token_ids(part.column("text"), path, pattern)
        columns = [*part.columns[:-1], pa.array(counts), _binary(ids.astype("<u4").view(np.uint8), 4 * counts)]
        names = [*part.schema.names[:-1], "n_tokens", "ids"]
        if decode:
            columns.append(_binary(*ranks(path).decoded(ids, counts)))
            names.append("decoded")
        yield pa.RecordBatch.from_arrays(columns, names)


def _decoded(batch: pa.RecordBatch, path: str) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "ids", SLICE_BYTES):
        data, offsets = raw(part.column("ids"))
        found = _binary(*ranks(path).decoded(np.frombuffer(data.tobytes(), "<u4").astype(np.int64), np.diff(offsets) // 4))
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], [*part.schema.names[:-1], "decoded"])


def encoded(
    docs: DataFrame, path: str, pattern: str, keys: list[str], text: str = "text", decode: bool = False
) -> DataFrame:
    """``keys``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit, binary) of every row of ``docs``.

    As the library of the vocabulary file has it: each match of ``pattern`` by itself, the
    lowest rank first, of equal ones the leftmost; no special tokens.  decode: also ``decoded``,
    the bytes that the ids stand for, made from the ids alone.  Null and empty texts have no
    ids and no bytes (not null); whole texts are encoded, so the longest must fit a worker's
    memory about twenty times over; repeated rows are encoded each.  Other columns of ``docs``
    are left out, whatever their names; keys may not be called like the new columns.
    """
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n_tokens bigint", "ids binary", *["decoded binary"] * decode])
    narrow = docs.select(*(docs[f"`{k}`"] for k in keys), docs[f"`{text}`"].alias("text"))
    return arrow_map(narrow, partial(_encoded, path=path, pattern=pattern, decode=decode), schema)


def decoded(encodings: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """``keys`` and ``decoded`` (binary) of every row of ``encodings``, from its column ``ids``; null ids have no bytes."""
    types = dict(encodings.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "decoded binary"])
    return arrow_map(encodings.select(*(f"`{k}`" for k in keys), "ids"), partial(_decoded, path=path), schema)

"""Token counts of whole texts by rank-synchronous merging of ragged symbol arrays."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tillflow.llm.text import LOWER, NOT_BLANK, Words, bounds, raw, slices, words
from tillflow.llm.work import arrow_map

NEVER = np.iinfo(np.int32).max
SLOTS = 1 << 18  # of the pair table; four times the pairs at least
MARKS = "\r\t\v\f"  # stand for special strings
KINDS = np.zeros(256, np.uint8)  # letters 1, digits 2, others 0
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KINDS[0x30:0x3A] = 2
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Merges:
    """A byte-level BPE vocabulary with word ends, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in _byte_characters()], np.int32)
        self.final = np.array([vocab[c + end] for c in _byte_characters()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.uint64) for i in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        if 4 * len(pairs) > SLOTS or len(vocab) > 1 << 31:
            raise ValueError("the vocabulary is too large for the pair table")
        self.keys = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
        self.ranks_at = np.full(SLOTS, NEVER, np.int32)
        keys = left << np.uint64(32) | right
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist(), strict=True)):
            while self.ranks_at[slot] != NEVER:
                slot = (slot + 1) % SLOTS
            self.keys[slot], self.ranks_at[slot] = key, rank
        self.specials = [t["content"] for t in described["added_tokens"] if t["special"]]
        self.special_ids = [t["id"] for t in described["added_tokens"] if t["special"]]
        if len(self.specials) > len(MARKS):
            raise ValueError("too many special strings")

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys * SPREAD) >> np.uint64(46)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, ``NEVER`` where they don't merge."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots = self._slots(keys)
        out = self.ranks_at[slots]
        again = np.flatnonzero((self.keys[slots] != keys) & (out != NEVER))
        while len(again):
            slots[again] = (slots[again] + 1) % SLOTS
            out[again] = self.ranks_at[slots[again]]
            again = again[(self.keys[slots[again]] != keys[again]) & (out[again] != NEVER)]
        return out

    def merged(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge the pre-tokens ``data[offsets[i]:offsets[i + 1]]``; parts of the result as they finish.

        A part has the pre-token's number of each symbol left, in order, and the symbols.  In a
        round, each sequence merges all places of its lowest-ranked pair at once.
        """
        length = np.diff(offsets)
        symbols = self.inner[data]
        ends = offsets[1:][length > 0] - 1
        symbols[ends] = self.final[data[ends]]
        owner = np.repeat(np.arange(len(length)), length)
        ranks = np.full(len(symbols), NEVER, np.int32)
        pairs = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[pairs] = self.ranks(symbols[pairs], symbols[pairs + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(starts, len(owner)))
            least = np.minimum.reduceat(ranks, starts)
            live = np.repeat(least < NEVER, sizes)
            if not live.all():
                yield owner[~live], symbols[~live]
                symbols, owner, ranks = symbols[live], owner[live], ranks[live]
                sizes, least = sizes[least < NEVER], least[least < NEVER]
            hit = ranks == np.repeat(least, sizes)
            touching = hit[1:] & hit[:-1]
            if touching.any():  # a run of one symbol merges from the left, two at a time
                place = np.arange(len(hit))
                first = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), place, 0))
                hit &= (place - first) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.made[ranks[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, owner, ranks = symbols[stay], owner[stay], ranks[stay]
            at -= np.arange(len(at))
            for changed in (at, at[at > 0] - 1):
                inside = changed[changed + 1 < len(owner)]
                inside = inside[owner[inside] == owner[inside + 1]]
                ranks[changed] = NEVER
                ranks[inside] = self.ranks(symbols[inside], symbols[inside + 1])

    def encoded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens one after the other, and how many each has."""
        parts = [*self.merged(data, offsets), (np.zeros(0, np.int64), np.zeros(0, np.int32))]
        owner = np.concatenate([p[0] for p in parts])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([p[1] for p in parts])[order], np.bincount(owner, minlength=len(offsets) - 1)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


# Fixed values of the tokenizer file: contractions, letters, single digits, the rest.
PRETOKENS = regex.compile(
    r"[\n\r\t\v\f]|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
)


def normal(text: str) -> str:
    """NFC, then lower case character by character (no final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@dataclass
class Runs:
    """The distinct runs of non-blank characters in a batch, as ids."""

    split: Words
    codes: np.ndarray  # the run of each word of ``split``
    ids: np.ndarray  # ids of all runs, one after the other
    sizes: np.ndarray  # ids of each run


def _plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Runs of ASCII characters without apostrophes and special strings."""
    special = data == ord("<")
    special[:-1] &= data[1:] == ord("|")
    return ~np.logical_or.reduceat((data >= 0x80) | (data == ord("'")) | special, offsets[:-1])


def _ascii_pretokens(runs: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """What ``PRETOKENS`` finds in plain runs: the run of each pre-token, and the pre-tokens."""
    data, offsets = raw(runs)
    kind = KINDS[data]
    begins = (kind == 2) | np.concatenate([[True], kind[1:] != kind[:-1]])
    begins[offsets[:-1]] = True
    starts = np.flatnonzero(begins)
    at = np.append(starts, len(data)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(LOWER[data]))
    return np.searchsorted(offsets, starts, side="right") - 1, found


def _other_pretokens(runs: list[str], specials: list[str]) -> tuple[np.ndarray, list[str]]:
    """The same for any runs; a special string becomes a blank of its own, which no run holds."""
    joined = "\n".join(runs)
    for mark, special in zip(MARKS, specials, strict=False):
        joined = joined.replace(special, mark)
    found = PRETOKENS.findall(normal(joined))
    line = np.fromiter((f == "\n" for f in found), bool, len(found))
    return np.cumsum(line)[~line], [f for f in found if f != "\n"]


def encoded_runs(texts: pa.Array, path: str) -> Runs:
    """Tokens never cross blanks, so each distinct run of other characters is encoded once for the batch.

    Runs with characters that the installed Unicode tables don't know yet are left to the
    tokenizer's own library, whose tables may be newer.
    """
    vocabulary = merges(path)
    split = words(texts, NOT_BLANK, lower=False)
    codes, distinct = split.coded()
    if not len(distinct):
        return Runs(split, codes, np.zeros(0, np.int32), np.zeros(0, np.int64))
    plain = _plain(*raw(distinct))
    others, place = distinct.filter(pa.array(~plain)).to_pylist(), np.flatnonzero(~plain)
    unknown = {c for c in set("".join(others)) if unicodedata.category(c) == "Cn"}
    foreign = {i: r for i, r in zip(place.tolist(), others, strict=True) if unknown and not unknown.isdisjoint(r)}
    if foreign:
        others = ["" if i in foreign else r for i, r in zip(place.tolist(), others, strict=True)]
    of_plain, first = _ascii_pretokens(distinct.filter(pa.array(plain)))
    of_other, second = _other_pretokens(others, vocabulary.specials)
    run = np.concatenate([np.flatnonzero(plain)[of_plain], place[of_other]])
    coded = pa.concat_arrays([first, pa.array(second, pa.string())]).dictionary_encode()
    kinds = coded.dictionary
    ids, sizes = vocabulary.encoded(*raw(kinds))
    starts = np.cumsum(sizes) - sizes
    for mark, number in zip(MARKS, vocabulary.special_ids, strict=False):
        kind = pc.index(kinds, mark).as_py()
        if kind >= 0:
            ids[starts[kind]], sizes[kind] = number, 1
    order = np.argsort(run, kind="stable")
    pretoken, run = coded.indices.to_numpy(zero_copy_only=False)[order], run[order]
    ids, owner = gathered(ids, starts, sizes, pretoken), np.repeat(run, sizes[pretoken])
    if foreign:
        own = [(i, e.ids) for i, e in zip(foreign, library(path).encode_batch(list(foreign.values()), add_special_tokens=False), strict=True)]
        ids = np.concatenate([ids, *(np.array(e, np.int32) for _, e in own)])
        owner = np.concatenate([owner, *(np.full(len(e), i) for i, e in own)])
        order = np.argsort(owner, kind="stable")
        ids, owner = ids[order], owner[order]
    return Runs(split, codes, ids, np.bincount(owner, minlength=len(distinct)))


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """``values[starts[i]:starts[i] + sizes[i]]`` of every i in ``which``, one after the other."""
    count = sizes[which]
    before = np.cumsum(count) - count
    return values[np.repeat(starts[which] - before, count) + np.arange(count.sum())]


def token_counts(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text, null texts none."""
    runs = encoded_runs(texts, path)
    return np.bincount(runs.split.rows(), runs.sizes[runs.codes], len(texts)).astype(np.int64)


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each has."""
    runs = encoded_runs(texts, path)
    starts = np.cumsum(runs.sizes) - runs.sizes
    counts = np.bincount(runs.split.rows(), runs.sizes[runs.codes], len(texts)).astype(np.int64)
    return gathered(runs.ids, starts, runs.sizes, runs.codes), counts


def _counted(batch: pa.RecordBatch, text: str, path: str) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, text):
        texts = part.column(text)
        new = [pa.array(np.diff(bounds(texts))), pa.array(token_counts(texts, path))]
        others = [(n, c) for n, c in zip(part.schema.names, part.columns, strict=True) if n != text]
        yield pa.RecordBatch.from_arrays([*(c for _, c in others), *new], [*(n for n, _ in others), "n_bytes", "n_tokens"])


def with_token_counts(docs: DataFrame, path: str, keys: list[str], text: str = "text", limit: int = 2048) -> DataFrame:
    """``keys``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    Null and empty texts have no bytes and no tokens; whole texts are counted; repeated rows
    are counted each.  path: the tokenizer file, at the same place on all workers.
    """
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n_bytes bigint", "n_tokens bigint"])
    counted = arrow_map(docs.select(*keys, text), partial(_counted, text=text, path=path), schema)
    return counted.withColumn("over_limit", counted["n_tokens"] > limit)

"""Interpolated modified Kneser-Ney trigram model, counted in Spark, kept as sorted hash arrays.

Words are numbered by the rank of their hash.  The model is a trie of sorted arrays in ranges
of words: the words a range has, the right words of each of its words (bigrams), and the right
words of each of these (trigrams), which need no more than 32 bits and a count each.

Counting: tasks count what they read and deal the counts, as packed differences, to the tasks
of the ranges, which add them up and write the arrays to the shared folder.  Trigrams are
counted by the place of their first two words among the bigrams.  What continues a bigram
or word is then known from the distinct trigrams and bigrams.  Scoring: workers map the arrays
into memory and look up the distinct bigrams and trigrams of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import varint
from tillflow.llm.files import mapped_together, qualified, written_together
from tillflow.llm.text import NOT_BLANK, slices, words
from tillflow.llm.work import new_folder
from tillflow.sources.staging import staged

SHARD_BYTES = 32 << 20  # text whose words go to one range
HELD = 2 << 20  # counts that a task gathers before it deals them out
MAPS = 8192  # files that a worker has mapped at a time
FAN = 32  # trigrams of a bigram from which its sums are stored
STRETCH = 64  # bigrams whose trigrams are found from one full place
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # no word has a line feed

_DEALT = "shard int, keys binary, counts binary"
_FOUND = "kind string, part int, n bigint, names array<string>, keys binary, counts binary, tally array<bigint>"

# The arrays of a file, in order.
WORDS = (np.uint64, np.int64)  # hashes, counts
PAIRS = (np.uint32, np.uint32, np.int64)  # first pair of each left word, right words, counts of pairs that begin a text
TRIPLES = (np.int64, np.uint16, np.uint32, np.uint32, np.uint8, np.int64, np.int64, np.uint32, np.int64)
AFTER = (np.uint8, np.int64, np.int64, np.int64, np.uint32, np.uint32)


@lru_cache(maxsize=MAPS)
def _arrays(folder: str, name: str, kinds: tuple[type, ...]) -> tuple[np.ndarray, ...]:
    return mapped_together(folder, name, kinds)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.diff(np.append(heads, len(keys)))


def _rising(values: np.ndarray) -> bytes:
    return varint.packed(values, np.array([len(values)]))[0].as_py()


def _numbers(values: np.ndarray) -> bytes:
    """Whole numbers from zero, packed as their running sums."""
    return _rising(np.cumsum(np.asarray(values, np.int64)))


def _values(packed: bytes) -> np.ndarray:
    return np.diff(varint.unpacked(packed), prepend=0)


def _small(counts: np.ndarray) -> list[np.ndarray]:
    """Counts in a byte each; those from 255 on with their places beside."""
    large = np.flatnonzero(counts > 254)
    return [np.minimum(counts, 255).astype(np.uint8), large, counts[large].astype(np.int64)]


def _full(small: np.ndarray, large_at: np.ndarray, large: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = small[at].astype(np.int64)
    big = np.flatnonzero(out == 255)
    out[big] = large[np.searchsorted(large_at, at[big])]
    return out


def _classes(counts: np.ndarray) -> list[np.ndarray]:
    return [counts == 1, counts == 2, counts > 2]


def _dealt(
    batches: Iterator[pa.RecordBatch],
    count: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
    edges: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Counts of the task's texts, by ranges of their keys that begin at ``edges``."""

    def flush(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        rows = list(_by_range(keys, counts, edges))
        columns = zip(*rows, strict=True)
        types = (pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["shard", "keys", "counts"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for part in slices(batch):
            held.append(count(part.column("text")))
            if sum(len(keys) for keys, _ in held) >= HELD:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                if len(held[0][0]) >= HELD // 2:  # else most have come again, and may do so still
                    yield flush(*held.pop())
    if held:
        keys, counts = _summed(*map(np.concatenate, zip(*held, strict=True)))
        if len(keys):
            yield flush(keys, counts)


def _by_shard(dealt: DataFrame, number: str, shards: int, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function`` over the rows of each shard, one shard a task; hashes of the numbers would put several into one."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from function(pa.Table.from_batches(held)).to_batches()

    return dealt.repartitionById(shards, F.col(number)).mapInArrow(over, schema)


def _by_range(keys: np.ndarray, counts: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Number, packed keys (from the range's edge on) and packed counts of each range with keys."""
    starts = np.append(np.searchsorted(keys, edges), len(keys))
    for number in np.flatnonzero(np.diff(starts)).tolist():
        part = slice(starts[number], starts[number + 1])
        inside = keys[part] - edges[number]
        # Hashes are as long packed as they are.
        packed = inside.tobytes() if inside.dtype == np.uint64 else _rising(inside)
        yield number, packed, _numbers(counts[part])


def _collected(rows: list[dict], kind: type = np.int64) -> tuple[np.ndarray, np.ndarray]:
    unpacked = (lambda k: np.frombuffer(k, np.uint64)) if kind is np.uint64 else varint.unpacked
    keys = [unpacked(r["keys"]) for r in rows]
    return _summed(np.concatenate([np.zeros(0, kind), *keys]), np.concatenate([np.zeros(0, np.int64), *(_values(r["counts"]) for r in rows)]))


# --- Words -----------------------------------------------------------------------


def _hashes(distinct: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in distinct.cast(pa.binary()).to_pylist()], np.uint64)


def _count_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    codes, distinct = words(texts, NOT_BLANK).coded()
    counts = np.bincount(codes, minlength=len(distinct))
    return np.append(_hashes(distinct), END), np.append(counts, len(texts))


def _word_shard(rows: pa.Table, folder: str, edges: np.ndarray) -> pa.Table:
    number = rows["shard"][0].as_py()
    keys, counts = _collected(rows.to_pylist(), np.uint64)
    name = written_together(folder, "words", [keys + edges[number], counts])
    return pa.table({"shard": pa.array([number], pa.int32()), "n": [len(keys)], "tokens": [int(counts.sum())], "name": [name]})


@dataclass(frozen=True)
class Vocabulary:
    folder: str
    shards: tuple[tuple[int, str], ...]  # first id, file
    edges: tuple[int, ...]  # least hash of each range that has words
    size: int
    tokens: int

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and count of each word hash; ``size + 1`` and 0 where it isn't in the vocabulary."""
        ids = np.full(len(hashes), self.size + 1, np.int64)
        found = np.zeros(len(hashes), np.int64)
        order = np.argsort(hashes)
        inside = hashes[order]
        starts = np.append(np.searchsorted(inside, np.array(self.edges, np.uint64)), len(inside))
        for (first, name), low, high in zip(self.shards, starts, starts[1:], strict=False):
            keys, counts = _arrays(self.folder, name, WORDS)
            at = np.minimum(np.searchsorted(keys, inside[low:high]), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == inside[low:high])
            ids[order[low:high][hit]] = first + at[hit]
            found[order[low:high][hit]] = counts[at[hit]]
        return ids, found


@dataclass
class Tokens:
    """The tokens of a batch, an end after each text; ids are those of the vocabulary."""

    left: np.ndarray  # the word before, ``size`` at the beginning of a text
    right: np.ndarray
    count: np.ndarray  # of the right word in the vocabulary
    row: np.ndarray
    later: np.ndarray  # whether there is a word before


def tokens(texts: pa.Array, vocabulary: Vocabulary) -> Tokens:
    split = words(texts, NOT_BLANK)
    codes, distinct = split.coded()
    found, counts = vocabulary.look_up(np.append(_hashes(distinct), END))
    ids, known = found[:-1][codes], counts[:-1][codes]
    n = len(texts)
    word = np.arange(len(ids)) + split.rows()
    last, first = split.first[1:] + np.arange(n), split.first[:-1] + np.arange(n)
    left, right, count = (np.empty(len(ids) + n, np.int64) for _ in range(3))
    right[word], right[last] = ids, found[-1]
    count[word], count[last] = known, counts[-1]
    left[word + 1 if len(word) else word] = ids
    left[first] = vocabulary.size
    later = np.ones(len(left), bool)
    later[first] = False
    return Tokens(left, right, count, np.repeat(np.arange(n), split.counts() + 1), later)


# --- Bigrams ---------------------------------------------------------------------


def _within(values: np.ndarray, begin: np.ndarray, end: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked value in its sorted stretch ``values[begin:end]``, -1 where it isn't there."""
    low, high = begin.astype(np.int64), end.astype(np.int64)
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        less = values[middle] < asked[left]
        low[left] = np.where(less, middle + 1, low[left])
        high[left] = np.where(less, high[left], middle)
        left = left[low[left] < high[left]]
    if not len(values):
        return np.full(len(low), -1)
    return np.where((low < end) & (values[np.minimum(low, len(values) - 1)] == asked), low, -1)


@dataclass(frozen=True)
class Pairs:
    """The bigrams, by ranges of ``part`` left words; a bigram's number is its place in all of them."""

    vocabulary: Vocabulary
    part: int
    names: tuple[str | None, ...]
    first: tuple[int, ...]  # number of each range's first bigram, and of all

    @property
    def width(self) -> int:
        """Keys are ``left * width + right``, and ``bigram * width + right``."""
        return self.vocabulary.size + 2

    def arrays(self, number: int) -> tuple[np.ndarray, ...]:
        return _arrays(self.vocabulary.folder, self.names[number], PAIRS)

    def ranges(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The ranges that ordered pair keys are in."""
        edges = np.arange(len(self.names), dtype=np.int64) * self.part * self.width
        starts = np.append(np.searchsorted(keys, edges), len(keys))
        for number in np.flatnonzero(np.diff(starts)).tolist():
            yield number, slice(starts[number], starts[number + 1])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ordered pair keys, -1 where there is no such bigram."""
        out = np.full(len(keys), -1, np.int64)
        for number, part in self.ranges(keys):
            if self.names[number] is None:
                continue
            begin, right, _ = self.arrays(number)
            left, asked = np.divmod(keys[part], self.width)
            left -= number * self.part
            at = _within(right, begin[left], begin[left + 1], asked)
            out[part] = np.where(at < 0, -1, at + self.first[number])
        return out


def _count_pairs(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    found = tokens(texts, vocabulary)
    return _counted(found.left * (vocabulary.size + 2) + found.right)


def _table(rows: list[dict]) -> pa.Table:
    schema = pa.schema(
        [("kind", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("names", pa.list_(pa.string()))]
        + [("keys", pa.binary()), ("counts", pa.binary()), ("tally", pa.list_(pa.int64()))]
    )
    return pa.Table.from_pylist(rows, schema)


def _pair_shard(rows: pa.Table, vocabulary: Vocabulary, part: int) -> pa.Table:
    """Write the bigrams of a range; how many left words each right word has, by ranges of right words."""
    number, width = rows["shard"][0].as_py(), vocabulary.size + 2
    keys, counts = _collected(rows.to_pylist())
    left, right = np.divmod(keys, width)
    begin = np.searchsorted(left, np.arange(part + 1))
    starting = counts[left == vocabulary.size - number * part]
    name = written_together(vocabulary.folder, "pairs", [begin.astype(np.uint32), right.astype(np.uint32), starting])
    out = [{"kind": "shard", "part": number, "n": len(keys), "names": [name]}]
    edges = np.arange(-(-width // part), dtype=np.int64) * part
    for to, ids, sums in _by_range(*_counted(right), edges):
        out.append({"kind": "right", "part": to, "keys": ids, "counts": sums})
    return _table(out)


# --- Trigrams --------------------------------------------------------------------


def _contexts(found: Tokens, pairs: Pairs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pair keys in order, their numbers, which of them each token ends, and the bigram before each token (-1: none)."""
    keys, which = np.unique(found.left * pairs.width + found.right, return_inverse=True)
    numbers = pairs.find(keys)
    before = np.full(len(which), -1, np.int64)
    before[1:] = numbers[which[:-1]]
    before[~found.later] = -1
    return keys, numbers, which, before


def _count_triples(texts: pa.Array, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    found = tokens(texts, pairs.vocabulary)
    *_, before = _contexts(found, pairs)
    there = before >= 0
    return _counted(before[there] * pairs.width + found.right[there])


def _triple_shard(rows: pa.Table, pairs: Pairs) -> pa.Table:
    """Write the trigrams of a range of bigrams; how many first words each of their later two has, by ranges of these."""
    number, width = rows["shard"][0].as_py(), pairs.width
    keys, counts = _collected(rows.to_pylist())
    before, right = np.divmod(keys, width)
    n = pairs.first[number + 1] - pairs.first[number]
    begin = np.searchsorted(before, np.arange(n + 1))
    base = begin[::STRETCH]
    relative = begin - np.repeat(base, STRETCH)[: n + 1]
    wide = len(relative) and int(relative.max()) >= 1 << 16  # rare: a bigram with very many trigrams
    hot = np.flatnonzero(np.diff(begin) >= FAN)
    sums = [np.add.reduceat(c, begin[hot]) if len(hot) else np.zeros(0, np.int64) for c in _ranged(counts, begin, hot)]
    name = written_together(
        pairs.vocabulary.folder, "triples",
        [
            base.astype(np.int64), np.zeros(0, np.uint16) if wide else relative.astype(np.uint16),
            begin.astype(np.uint32) if wide else np.zeros(0, np.uint32), right.astype(np.uint32),
            *_small(counts), hot.astype(np.uint32), np.stack(sums, axis=1).astype(np.int64),
        ],
    )
    out = [{"kind": "shard", "part": number, "names": [name], "tally": [int(np.sum(counts == k)) for k in (1, 2, 3, 4)]}]
    middle = pairs.arrays(number)[1][before].astype(np.int64)
    edges = np.arange(len(pairs.names), dtype=np.int64) * pairs.part * width
    for to, pair, firsts in _by_range(*_counted(middle * width + right), edges):
        out.append({"kind": "pair", "part": to, "keys": pair, "counts": firsts})
    return _table(out)


def _ranged(counts: np.ndarray, begin: np.ndarray, hot: np.ndarray) -> list[np.ndarray]:
    """Counts and their classes, with nothing counted outside the stretches of ``hot``."""
    inside = np.zeros(len(counts) + 1, np.int64)
    np.add.at(inside, begin[hot], 1)
    np.add.at(inside, begin[hot + 1], -1)
    inside = np.cumsum(inside[:-1]) > 0
    return [counts * inside, *((c & inside).astype(np.int64) for c in _classes(counts))]


# --- What continues --------------------------------------------------------------


def _after_part(rows: pa.Table, pairs: Pairs) -> pa.Table:
    """Write what a range of words needs: first words of its bigrams, sums of these, left words of its words."""
    number, given = rows["part"][0].as_py(), rows.to_pylist()
    ids, lefts = _collected([r for r in given if r["kind"] == "right"])
    single = np.zeros(pairs.part, np.int64)
    single[ids] = lefts
    firsts, begin = np.zeros(0, np.int64), np.zeros(pairs.part + 1, np.int64)
    if pairs.names[number] is not None:
        begin, right, starting = pairs.arrays(number)
        begin = begin.astype(np.int64)
        left = np.repeat(np.arange(pairs.part), np.diff(begin))
        firsts = np.zeros(len(right), np.int64)
        keys, counts = _collected([r for r in given if r["kind"] == "pair"])
        firsts[np.searchsorted(left * pairs.width + right, keys)] = counts
        # Nothing comes before the beginning of a text: its bigrams have their counts.
        firsts[left == pairs.vocabulary.size - number * pairs.part] = starting
    some = np.flatnonzero(np.diff(begin))
    sums = np.zeros((pairs.part, 4), np.int64)
    for column, values in enumerate([firsts, *_classes(firsts)]):
        if len(some):
            sums[some, column] = np.add.reduceat(values.astype(np.int64), begin[some])
    name = written_together(
        pairs.vocabulary.folder, "after",
        [*_small(firsts), sums[:, 0].copy(), sums[:, 1:].astype(np.uint32), single.astype(np.uint32)],
    )
    tally = [np.sum(firsts == k) for k in (1, 2, 3, 4)] + [np.sum(single == k) for k in (1, 2, 3, 4)] + [single.sum(), np.sum(single > 2)]
    return pa.table({"part": pa.array([number], pa.int32()), "name": [name], "tally": [[int(t) for t in tally]]})


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more, from how many n-grams have counts 1 to 4.

    Where a figure is missing, half the count of its class is taken off instead.
    """
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [1 - 2 * y * n2 / n1 if n1 and n2 else 0.5, 2 - 3 * y * n3 / n2 if n2 and n3 else 1.0, 3 - 4 * y * n4 / n3 if n3 and n4 else 1.5]
    return np.array([0.0, *(min(max(d, 0.0), k) for k, d in enumerate(found, 1))])


def _interpolated(counts: np.ndarray, total: np.ndarray, classes: np.ndarray, taken: np.ndarray, lower: np.ndarray) -> np.ndarray:
    safe = np.maximum(total, 1)
    weight = np.where(total > 0, classes @ taken[1:] / safe, 1.0)
    return np.maximum(counts - taken[np.minimum(counts, 3)], 0) / safe + weight * lower


@dataclass
class Model:
    pairs: Pairs
    triples: dict[int, str] = field(default_factory=dict)
    after: dict[int, str] = field(default_factory=dict)
    triple_discounts: np.ndarray | None = None
    pair_discounts: np.ndarray | None = None
    word_discounts: np.ndarray | None = None
    continuations: int = 0  # distinct bigrams
    word_weight: float = 1.0  # what the words leave to the uniform distribution

    @property
    def vocabulary(self) -> Vocabulary:
        return self.pairs.vocabulary

    def word_probability(self, left_words: np.ndarray) -> np.ndarray:
        """From how many left words a word has, interpolated with one in ``size + 1``."""
        taken = self.word_discounts[np.minimum(left_words, 3)]
        return np.maximum(left_words - taken, 0) / max(self.continuations, 1) + self.word_weight / (self.vocabulary.size + 1)

    def _of_words(self, ids: np.ndarray, which: int, width: int) -> np.ndarray:
        """Columns of ``AFTER`` for words in any order."""
        out = np.zeros((len(ids), width), np.int64)
        part = ids // self.pairs.part
        for number in np.unique(part).tolist():
            if number in self.after:
                at = np.flatnonzero(part == number)
                stored = _arrays(self.vocabulary.folder, self.after[number], AFTER)[which].reshape(-1, width)
                out[at] = stored[ids[at] - number * self.pairs.part]
        return out

    def pair_probability(self, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Probability of the right word of each of the ordered pair keys (and their numbers) after its left word."""
        left, right = np.divmod(keys, self.pairs.width)
        firsts = np.zeros(len(keys), np.int64)
        for number, part in self.pairs.ranges(keys):
            if number in self.after:
                there = np.flatnonzero(numbers[part] >= 0) + part.start
                small, large_at, large = _arrays(self.vocabulary.folder, self.after[number], AFTER)[:3]
                firsts[there] = _full(small, large_at, large, numbers[there] - self.pairs.first[number])
        lefts, of = np.unique(left, return_inverse=True)
        rights, at = np.unique(right, return_inverse=True)
        word = self.word_probability(self._of_words(rights, 5, 1)[:, 0])[at]
        return _interpolated(firsts, self._of_words(lefts, 3, 1)[of, 0], self._of_words(lefts, 4, 3)[of], self.pair_discounts, word)

    def triple_probability(self, keys: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """The same after two words: ordered keys of bigram and right word; lower: without the first word."""
        before, right = np.divmod(keys, self.pairs.width)
        counts, sums = np.zeros(len(keys), np.int64), np.zeros((len(keys), 4), np.int64)
        starts = np.append(np.searchsorted(before, np.array(self.pairs.first[:-1])), len(before))
        for number in np.flatnonzero(np.diff(starts)).tolist():
            if number not in self.triples:
                continue
            part = slice(starts[number], starts[number + 1])
            found = _arrays(self.vocabulary.folder, self.triples[number], TRIPLES)
            counts[part], sums[part] = _triples_of(found, before[part] - self.pairs.first[number], right[part])
        return _interpolated(counts, sums[:, 0], sums[:, 1:], self.triple_discounts, lower)

    def probabilities(self, found: Tokens) -> np.ndarray:
        """Probability of each token of a batch."""
        keys, numbers, which, before = _contexts(found, self.pairs)
        out = self.pair_probability(keys, numbers)[which]
        later = np.flatnonzero(before >= 0)
        triples = before[later] * self.pairs.width + found.right[later]
        order = np.argsort(triples)
        later = later[order]
        out[later] = self.triple_probability(triples[order], out[later])
        return out


def _triples_of(found: tuple[np.ndarray, ...], before: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of trigrams, and the sums and classes of counts of their bigrams (ordered places in the range)."""
    base, relative, begins, rights, small, large_at, large, hot, hot_sums = found

    def begin(at: np.ndarray) -> np.ndarray:
        return begins[at].astype(np.int64) if len(begins) else base[at // STRETCH] + relative[at]

    new = np.concatenate([[True], before[1:] != before[:-1]])
    contexts, of = before[new], np.cumsum(new) - 1
    low, high = begin(contexts), begin(contexts + 1)
    at = _within(rights, low[of], high[of], right)
    counts = np.where(at < 0, 0, _full(small, large_at, large, np.maximum(at, 0))) if len(rights) else np.zeros(len(right), np.int64)
    sums = np.zeros((len(contexts), 4), np.int64)
    fan = high - low
    many = np.flatnonzero(fan >= FAN)
    if len(many):
        sums[many] = hot_sums.reshape(-1, 4)[np.searchsorted(hot, contexts[many])]
    few = np.flatnonzero((fan < FAN) & (fan > 0))
    if len(few):
        size = fan[few]
        ends = np.cumsum(size)
        places = np.repeat(low[few] - (ends - size), size) + np.arange(ends[-1])
        values = _full(small, large_at, large, places)
        for column, counted in enumerate([values, *_classes(values)]):
            sums[few, column] = np.add.reduceat(counted.astype(np.int64), ends - size)
    return counts, sums[of]


# --- Learning and scoring --------------------------------------------------------


def learn(texts: DataFrame) -> Model:
    """A model of all texts in column ``text``; null texts count as empty ones.

    The driver gets the names and sizes of the files, three for each 32 MB of text.
    """
    spark = texts.sparkSession
    texts = texts.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    folder = qualified(spark, new_folder(spark, "model"))

    hash_edges = np.array([(i << 64) // shards for i in range(shards)], np.uint64)
    dealt = texts.mapInArrow(partial(_dealt, count=_count_words, edges=hash_edges), _DEALT)
    written_words = _by_shard(
        dealt, "shard", shards, partial(_word_shard, folder=folder, edges=hash_edges), "shard int, n bigint, tokens bigint, name string"
    )
    rows = staged(written_words, "vocabulary").orderBy("shard").collect()
    first = np.cumsum([0, *(r["n"] for r in rows)]).tolist()
    files = tuple((f, r["name"]) for f, r in zip(first, rows, strict=False))
    vocabulary = Vocabulary(folder, files, tuple(int(hash_edges[r["shard"]]) for r in rows), first[-1], sum(r["tokens"] for r in rows))
    width = vocabulary.size + 2
    if width >= 1 << 32:
        raise ValueError("word ids of 32 bits don't suffice for this vocabulary")
    part = -(-width // shards)
    shards = -(-width // part)  # each range has words

    pair_edges = np.arange(shards, dtype=np.int64) * part * width
    dealt = texts.mapInArrow(partial(_dealt, count=partial(_count_pairs, vocabulary=vocabulary), edges=pair_edges), _DEALT)
    found = staged(_by_shard(dealt, "shard", shards, partial(_pair_shard, vocabulary=vocabulary, part=part), _FOUND), "pairs")
    made = {r["part"]: r for r in found.where("kind = 'shard'").select("part", "n", "names").collect()}
    names = tuple(made[i]["names"][0] if i in made else None for i in range(shards))
    numbers = np.cumsum([0, *(made[i]["n"] if i in made else 0 for i in range(shards))]).tolist()
    if numbers[-1] * width >= 1 << 62:
        raise ValueError("trigram keys of 62 bits don't suffice for this corpus")
    pairs = Pairs(vocabulary, part, names, tuple(numbers))

    triple_edges = np.array(numbers[:-1], np.int64) * width
    dealt = texts.mapInArrow(partial(_dealt, count=partial(_count_triples, pairs=pairs), edges=triple_edges), _DEALT)
    triples = staged(_by_shard(dealt, "shard", shards, partial(_triple_shard, pairs=pairs), _FOUND), "triples")
    every = spark.range(shards).select(F.lit("none").alias("kind"), F.col("id").cast("int").alias("part"))
    tallies = [t.select("kind", "part", "keys", "counts") for t in (found.where("kind = 'right'"), triples.where("kind = 'pair'"))]
    tallies = every.unionByName(tallies[0], allowMissingColumns=True).unionByName(tallies[1], allowMissingColumns=True)
    after = _by_shard(tallies, "part", shards, partial(_after_part, pairs=pairs), "part int, name string, tally array<bigint>")
    after = staged(after, "after")

    model = Model(pairs)
    of_triples, of_words = np.zeros(4, np.int64), np.zeros(10, np.int64)
    for row in triples.where("kind = 'shard'").select("part", "names", "tally").collect():
        model.triples[row["part"]] = row["names"][0]
        of_triples += np.array(row["tally"])
    for row in after.collect():
        model.after[row["part"]] = row["name"]
        of_words += np.array(row["tally"])
    model.triple_discounts, model.pair_discounts = discounts(*of_triples.tolist()), discounts(*of_words[:4].tolist())
    model.word_discounts, model.continuations = discounts(*of_words[4:8].tolist()), int(of_words[8])
    if model.continuations:
        model.word_weight = float(of_words[[4, 5, 9]] @ model.word_discounts[1:]) / model.continuations
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    vocabulary = model.vocabulary
    for batch in batches:
        for part in slices(batch):
            found = tokens(part.column("text"), vocabulary)
            n, row = part.num_rows, found.row
            logs = np.log10(model.probabilities(found))
            base = np.log10((found.count + 1) / (vocabulary.tokens + vocabulary.size + 1))
            new = {
                "n_tokens": pa.array(np.bincount(row, minlength=n), pa.int64()),
                "n_known": pa.array(np.bincount(row, found.count > 0, n).astype(np.int64)),
                "base_score": pa.array(np.bincount(row, base, n)),
                "score": pa.array(np.bincount(row, logs, n)),
            }
            others = [(k, c) for k, c in zip(part.schema.names, part.columns, strict=True) if k != "text"]
            yield pa.RecordBatch.from_arrays([*(c for _, c in others), *new.values()], [*(k for k, _ in others), *new])


def scored(docs: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys``, ``n_tokens``, ``n_known``, ``base_score``, ``score``, ``perplexity`` for every row.

    A text's tokens are its words (lower-cased in ASCII) and one end.  score: log10 of its
    probability; base_score: the same under add-one counts of single tokens; n_known: tokens
    that the model was taught.  Null and empty texts are one end; keys may be null or repeated.
    """
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n_tokens bigint, n_known bigint, base_score double, score double"])
    found = docs.select(*keys, "text").mapInArrow(partial(_scored, model=model), schema)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))

"""Language identification of words and texts.

The script of a word narrows the candidates to the languages that were learned in it; byte
trigrams score the word under each; a Viterbi pass over the words of a text, with a penalty
for each switch, labels spans of one language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.text import Words, raw, slices, words
from tillflow.llm.work import arrow_map, under_own_names
from tillflow.sources.staging import cleared, staged

SAMPLE = 2000  # documents of a language that the model learns from, at most
MOST_LANGUAGES = 256  # that it learns: those with most documents
BUCKETS = 1 << 16  # of trigrams
PENALTY = 6.0  # natural log units that a switch of language costs
FLOOR = -8.0  # a word counts against a language by so much at most
UNKNOWN = "und"

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# First code points of script ranges, and their scripts (blocks of Unicode).
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"),
    (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"),
    (0xFF5F, "other"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
NAMES = sorted({s for _, s in SCRIPTS})


@lru_cache(maxsize=1)
def _code_points() -> tuple[np.ndarray, np.ndarray]:
    """Script number of each code point, and whether it is a letter."""
    script = np.zeros(0x110000, np.uint8)
    for begin, name in SCRIPTS:
        script[begin:] = NAMES.index(name)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return script, letter


def _scripts(distinct: pa.Array) -> np.ndarray:
    """Script of the first letter of each word, -1 where it has none."""
    data, offsets = raw(distinct)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    script, letter = _code_points()
    owner = np.searchsorted(offsets, leads, side="right") - 1
    at = np.flatnonzero(letter[points])
    of, first = np.unique(owner[at], return_index=True)
    out = np.full(len(distinct), -1)
    out[of] = script[points[at[first]]]
    return out


def _trigrams(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram of the words, bounded by blanks, and the word of each."""
    data, offsets = raw(distinct)
    count = np.arange(len(distinct))
    padded = np.full(len(data) + 2 * len(distinct) + 2, 32, np.uint32)
    padded[np.arange(len(data)) + 2 * np.repeat(count, np.diff(offsets)) + 1] = data
    sizes = np.diff(offsets)
    owner = np.repeat(count, sizes)
    at = np.arange(len(data)) + 2 * owner
    key = padded[at] | padded[at + 1] << np.uint32(8) | padded[at + 2] << np.uint32(16)
    return (key * np.uint32(2654435761)) >> np.uint32(16), owner


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # log probability by bucket and language
    allowed: np.ndarray  # by script and language

    def scores(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word by language, the best being zero, and whether the word counts."""
        out = np.zeros((len(distinct), len(self.languages)), np.float32)
        if not len(distinct):
            return out, np.zeros(0, bool)
        buckets, owner = _trigrams(distinct)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        out = np.add.reduceat(self.logs[buckets], starts, axis=0)
        script = _scripts(distinct)
        allowed = self.allowed[script] & (script >= 0)[:, None]
        counts = allowed.any(axis=1)
        out[~allowed & counts[:, None]] = -np.inf
        out = np.maximum(out - out.max(axis=1, keepdims=True), FLOOR)
        out[~counts] = 0
        return out, counts


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of each word; the words of a row are ``first[r]`` to ``first[r + 1]``.

    One step takes the next word of all rows that still have one.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    steps = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(steps), side="left")  # rows with more words than the step's number
    value = np.zeros((len(size), scores.shape[1]), np.float32)
    switched = np.zeros(scores.shape, bool)
    best = np.zeros(len(scores), np.int16)
    for t in range(steps):
        n = live[t]
        at, now = begin[:n] + t, value[:n]
        top = now.argmax(axis=1)
        other = now[np.arange(n), top] - penalty
        best[at], switched[at] = top, now < other[:, None]
        np.maximum(now, other[:, None], out=now)
        now += scores[at]
        now -= now.max(axis=1, keepdims=True)
    labels = np.zeros(len(scores), np.int16)
    state = value.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        at, now = begin[: live[t]] + t, state[: live[t]]
        labels[at] = now
        if t:
            now[...] = np.where(switched[at, now], best[at], now)
    return labels


def _learned(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Counts of trigram buckets, and of words by script from ``BUCKETS`` on, by language.

    A row that has copies counts for its share of them.
    """
    for part in slices(batch):
        languages = part.column("lang").dictionary_encode()
        for number, language in enumerate(languages.dictionary.to_pylist()):
            rows = pc.equal(languages.indices, number)
            split = words(part.column("text").filter(rows), LETTERS)
            codes, distinct = split.coded()
            if not len(distinct):
                continue
            share = 1 / part.column("copies").filter(rows).to_numpy()
            times = np.bincount(codes, share[split.rows()], len(distinct))
            buckets, owner = _trigrams(distinct)
            script = _scripts(distinct)
            buckets = np.concatenate([buckets, BUCKETS + script[script >= 0]])
            weight = np.concatenate([times[owner], times[script >= 0]])
            counts = np.bincount(buckets, weight, BUCKETS + len(NAMES))
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])], ["lang", "bucket", "n"]
            )


def learn(docs: DataFrame, per_language: int = SAMPLE) -> Model:
    """A model of the languages in ``lang``, from at most ``per_language`` pairs of ``doc_id`` and ``text`` of each.

    The pairs are those with the smallest hashes; ids may be null, and repeated rows teach once.
    Rows without words or language teach nothing and take no place of others.  Should ``lang``
    have more than ``MOST_LANGUAGES`` values, those with most pairs are learned.  What reaches
    the driver is one count for each bucket and language.
    """
    named = {"hash__": F.xxhash64("doc_id", "text"), "size__": F.octet_length("text")}
    worded = F.col("text").rlike(r"[A-Za-z]|[^\x00-\x7F]")  # some of LETTERS
    usable = docs.where(worded & F.col("lang").isNotNull()).select("doc_id", "lang", "text").withColumns(named)
    with cleared(docs.sparkSession):
        pairs = usable.groupBy("lang", "hash__", "size__").agg(F.count(F.lit(1)).alias("copies"))
        pairs = staged(pairs, "pairs")
        # A language may hold most rows: a share of them by hash, twice what is wanted, is numbered.
        total = pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
        total = total.orderBy(F.desc("total"), "lang").limit(MOST_LANGUAGES)
        order = F.shiftrightunsigned("hash__", 33)
        near = pairs.join(F.broadcast(total), "lang").where(order * F.col("total") < F.lit(2 * per_language * (1 << 31)))
        number = F.row_number().over(Window.partitionBy("lang").orderBy(order, "hash__", "size__"))
        chosen = near.withColumn("number", number).where(F.col("number") <= per_language)
        # At most per_language pairs for each language the driver has a column for: safe to broadcast.
        picked = F.broadcast(chosen.select("lang", "hash__", "size__", "copies"))
        sample = usable.join(picked, ["lang", "hash__", "size__"]).select("lang", "text", "copies")
        found = arrow_map(sample, _learned, "lang string, bucket int, n double").groupBy("lang", "bucket")
        # The shares of copies add up to whole numbers.
        found = found.agg(F.round(F.sum("n")).cast("bigint").alias("n"))
        rows = found.toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS + len(NAMES), max(1, len(languages))))
    place = [languages.index(name) for name in rows.column("lang").to_pylist()]
    counts[rows.column("bucket").to_numpy(), place] = rows.column("n").to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    smooth = grams + 0.5
    # A script is a language's own if it has one word in fifty of its words at least.
    return Model(
        languages or [UNKNOWN],
        np.log(smooth / smooth.sum(axis=0)).astype(np.float32),
        (scripts > 0) & (scripts >= 0.02 * scripts.sum(axis=0)),
    )


def _spans(split: Words, labels: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, label, begin and end (code points of the text) of each run of one label."""
    rows = split.rows()
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (labels[1:] != labels[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(rows))[: len(head)] - 1
    data, offsets = raw(texts)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    row = rows[head]
    base = before[offsets[row]]
    return row, labels[head], before[split.spans[0][head]] - base, before[split.spans[1][tail]] - base


@dataclass
class Labels:
    """The language of each word of a batch and of each of its texts."""

    split: Words
    labels: np.ndarray  # the language of each word
    names: np.ndarray  # of all languages, and of texts without one
    pick: np.ndarray  # the language of each text, as its place in ``names``
    share: np.ndarray  # of its words in that language


def labelled(texts: pa.Array, model: Model, penalty: float) -> Labels:
    n = len(texts)
    split = words(texts, LETTERS)
    codes, distinct = split.coded()
    scores, counts = model.scores(distinct)
    letter = _scripts(distinct) >= 0 if len(distinct) else np.zeros(0, bool)
    labels = viterbi(scores[codes], split.first, penalty)
    rows, width = split.rows(), len(model.languages)
    votes = np.bincount(rows * width + labels, counts[codes], n * width).reshape(n, width)
    known = votes.sum(axis=1)
    some = np.bincount(rows, letter[codes], n) > 0
    pick = np.where(some, votes.argmax(axis=1), width)
    share = np.where(some & (known > 0), votes.max(axis=1) / np.maximum(known, 1), 0.0)
    return Labels(split, labels, np.array([*model.languages, UNKNOWN]), pick, share)


def _identified(batch: pa.RecordBatch, text: str, model: Model, penalty: float) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, text):
        texts = part.column(text)
        found = labelled(texts, model, penalty)
        row, label, begin, end = _spans(found.split, found.labels, texts)
        spans = pa.StructArray.from_arrays(
            [pa.array(found.names[label]), pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["lang", "start", "end"]
        )
        first = np.searchsorted(row, np.arange(part.num_rows + 1))
        others = [(k, c) for k, c in zip(part.schema.names, part.columns, strict=True) if k != text]
        new = [pa.array(found.names[found.pick]), pa.array(found.share), pa.ListArray.from_arrays(pa.array(first, pa.int32()), spans)]
        yield pa.RecordBatch.from_arrays([*(c for _, c in others), *new], [*(k for k, _ in others), "lang_pred", "score", "spans"])


def _accepted(batch: pa.RecordBatch, text: str, model: Model, penalty: float, least: float) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, text):
        found = labelled(part.column(text), model, penalty)
        stays = (found.names[found.pick] != UNKNOWN) & (found.share >= least)
        yield part.filter(pa.array(stays))


def identified(docs: DataFrame, model: Model, keys: list[str], text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """``keys``, ``lang_pred``, ``score`` and ``spans`` for every row.

    lang_pred is the language with most words, score its share of the words in learned scripts
    (0 to 1).  Null texts and texts without a letter are ``und`` with score 0; texts in no learned
    script have the first language with score 0.  spans: runs of words of one language, in code
    points.  keys may be null, repeated or of any type.
    """
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keys), "lang_pred string, score double, spans array<struct<lang:string,start:int,end:int>>"])
    inputs = docs.select(*(f"`{c}`" for c in keys), F.col(f"`{text}`").alias("text__"))
    return arrow_map(inputs, partial(_identified, text="text__", model=model, penalty=penalty), schema)


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.3) -> DataFrame:
    """``docs`` whose language is known and has the share ``least`` of the words; other rows go."""

    def kept(given: DataFrame, column: str) -> DataFrame:
        return arrow_map(given, partial(_accepted, text=column, model=model, penalty=PENALTY, least=least), given.schema)

    return under_own_names(docs, kept, text)

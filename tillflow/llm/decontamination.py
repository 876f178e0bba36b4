"""Benchmark decontamination with a positional inverted index over the training documents.

The index is kept by segments, runs of documents of about ``SEGMENT_BYTES``.  A row holds the
positions of one term in one segment: a rising list of word numbers, as differences in
variable-length bytes.  Documents follow each other with one free number between them, so no
phrase passes from one into the next.  Two sorts of rows are special: the empty term lists
where the documents begin, and rows without a term describe one document each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm import varint
from tillflow.llm.text import ALPHANUMERIC, slices, words
from tillflow.llm.work import arrow_map, under_own_names
from tillflow.sources.staging import staged

SEGMENT_BYTES = 8 << 20
WIDTH = 10
STARTS = ""  # the term under which a segment lists where its documents begin


_number = 0


def _segment_number() -> int:
    """A number that no other segment of the job has: the partition, then a count within it."""
    global _number
    _number += 1
    return (TaskContext.get().partitionId() << 32) + _number


def _indexed(batch: pa.RecordBatch, text: str, keys: list[str]) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, text, SEGMENT_BYTES):
        segment = _segment_number()
        found = words(part.column(text), ALPHANUMERIC)
        codes, terms = found.coded()
        rows = np.arange(part.num_rows)
        starts = found.first[:-1] + rows
        positions = np.arange(len(found)) + found.rows()
        entries = np.sort(codes.astype(np.int64) << 40 | positions)
        counts = np.concatenate([[part.num_rows], np.bincount(codes, minlength=len(terms))])
        lists = np.concatenate([starts, entries & (1 << 40) - 1])
        n = len(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, segment)), pa.concat_arrays([pa.array([STARTS]), terms]), pa.array(counts),
                varint.packed(lists, counts), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                *(pa.nulls(n, part.column(k).type) for k in keys),
            ],
            ["segment", "term", "n", "postings", "ordinal", "n_words", *keys],
        )
        n = part.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, segment)), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.binary()), pa.array(rows, pa.int32()), pa.array(found.counts()),
                *(part.column(k) for k in keys),
            ],
            ["segment", "term", "n", "postings", "ordinal", "n_words", *keys],
        )


def index(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The index of all documents, written to the shared folder and read back.

    keys: columns that name a document in the results; they may be null or repeated, as rows
    are told apart by segment and ordinal.  Null and empty texts are documents without words.
    """
    reserved = {"segment", "term", "n", "postings", "ordinal", "n_words"} & set(keys)
    if reserved:
        raise ValueError(f"rename the key columns {sorted(reserved)}")
    types = dict(docs.dtypes)
    schema = "segment bigint, term string, n bigint, postings binary, ordinal int, n_words bigint"
    schema = ", ".join([schema, *(f"`{k}` {types[k]}" for k in keys)])
    return staged(arrow_map(docs.select(*keys, text), partial(_indexed, text=text, keys=keys), schema), "index")


def _item_terms(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch):
        found = words(part.column("text"), ALPHANUMERIC)
        lists = pa.ListArray.from_arrays(pa.array(found.first, pa.int32()), found.strings())
        yield pa.RecordBatch.from_arrays([part.column("item_id"), lists], ["item_id", "terms"])


def _windows(items: DataFrame, frequency: DataFrame, width: int) -> DataFrame:
    """Windows all of whose terms are in the index: item, first word, and the rarest term with its place."""
    placed = items.select("item", F.posexplode("terms").alias("at", "term"))
    counted = placed.join(frequency, "term", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    each = F.sort_array(F.collect_list(F.struct("at", "total", "term")))
    lists = counted.groupBy("item").agg(each.alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))

    def anchored(start: Column) -> Column:
        inside = F.slice("words", start + 1, width)
        return F.struct(
            start.alias("start"),
            F.array_min(F.transform(inside, lambda w: F.struct(w["total"], w["at"] - start, w["term"]))).alias("rarest"),
        )

    windows = lists.select("item", F.inline(F.transform(F.sequence(F.lit(0), last), anchored)))
    return windows.where("rarest.total > 0").select(
        "item", "start", F.col("rarest.term").alias("term"), F.col("rarest.col2").alias("offset")
    )


def _runs(start: np.ndarray, position: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Maximal runs of windows that follow each other in item and document: first window, its position, count."""
    order = np.lexsort((start, position - start))
    start, position = start[order], position[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 1) | (np.diff(position) != 1)
    heads = np.flatnonzero(new)
    yield from zip(start[heads].tolist(), position[heads].tolist(), np.diff(np.append(heads, len(start))).tolist(), strict=True)


_MATCH = pa.schema(
    [("segment", pa.int64()), ("ordinal", pa.int32()), ("item_id", pa.string()), ("kind", pa.string()),
     ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]
)
_MATCH_DDL = "segment bigint, ordinal int, item_id string, kind string, item_start bigint, start bigint, length bigint"


def _matched(lists: pa.Table, asked: pa.Table, width: int, slack: int | None) -> pa.Table:
    """Matches of the asked windows in one segment."""
    if not asked.num_rows:
        return _MATCH.empty_table()
    stored = dict(zip(lists.column("term").to_pylist(), lists.column("postings").to_pylist(), strict=True))
    sizes = dict(zip(lists.column("term").to_pylist(), lists.column("n").to_pylist(), strict=True))
    decoded: dict[str, np.ndarray] = {}

    def positions(term: str) -> np.ndarray:
        if term not in decoded:
            decoded[term] = varint.unpacked(stored[term])
        return decoded[term]

    starts = positions(STARTS)
    out: list[tuple] = []

    def add(kind: str, item: str, item_start: int, at: int, length: int) -> None:
        row = int(np.searchsorted(starts, at, side="right")) - 1
        out.append((asked["segment"][0].as_py(), row, item, kind, item_start, at - int(starts[row]), length))

    for row in asked.to_pylist():
        terms, item = row["terms"], row["item_id"]
        size = min(width, len(terms))
        found_start, found_at = [], []
        for start, offset in zip(row["starts"], row["offsets"], strict=True):
            inside = terms[start : start + size]
            if any(t not in stored for t in inside):
                continue
            anchor = positions(inside[offset])
            begin = anchor - offset
            rest = sorted((sizes[t], i, t) for i, t in enumerate(inside) if i != offset)
            for _, i, term in rest:  # from the rarest list on, until nothing is left
                held = positions(term)
                at = np.minimum(np.searchsorted(held, begin + i), len(held) - 1)
                begin = begin[held[at] == begin + i]
                if not len(begin):
                    break
            found_start.append(np.full(len(begin), start))
            found_at.append(begin)
            if slack is not None:
                near = np.setdiff1d(anchor, begin + offset)
                first = starts[np.searchsorted(starts, near, side="right") - 1]
                end = np.append(starts, np.iinfo(np.int64).max)[np.searchsorted(starts, near, side="right")]
                for term in {t for _, _, t in rest}:
                    held = positions(term)
                    at = np.searchsorted(held, np.maximum(near - size - slack + 1, first))
                    there = held[np.minimum(at, len(held) - 1)]
                    ok = (at < len(held)) & (there < np.minimum(near + size + slack, end))
                    near, first, end = near[ok], first[ok], end[ok]
                for place in near.tolist():
                    add("near", item, start, place, 1)
        if found_at:
            for start, at, count in _runs(np.concatenate(found_start), np.concatenate(found_at)):
                add("exact", item, start, at, count + size - 1)
    columns = zip(*out, strict=True) if out else [[] for _ in _MATCH]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MATCH, strict=True)], schema=_MATCH)


def matches(indexed: DataFrame, benchmark: DataFrame, width: int = WIDTH, slack: int | None = None) -> DataFrame:
    """Where windows of ``width`` consecutive item words occur in the indexed documents.

    benchmark: ``item_id`` and ``text``.  An item of fewer words, but not none, is one window;
    items without an id match as any other, under a null item_id; items that share an id count
    as one.  Columns: segment, ordinal (the document), item_id as string, kind, item_start,
    start and length.  ``exact``
    rows are maximal runs: ``length`` words from word ``start`` of the document equal those of
    the item from ``item_start``.  With ``slack``, ``near`` rows tell at word ``start`` an
    occurrence of the window's rarest term that has every other term of the window within
    ``width + slack - 1`` words in the same document, but isn't part of an exact match.

    Lists of item terms only are read from the index.  A window is asked of those segments
    that have its rarest term, and there the lists are intersected from the rarest on.
    """
    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    items = staged(
        arrow_map(named, _item_terms, "item_id string, terms array<string>")
        .where(F.size("terms") > 0)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    terms = items.select(F.explode("terms").alias("term")).distinct()
    listed = indexed.where("term IS NOT NULL").select("segment", "term", "n", "postings")
    lists = staged(listed.join(terms, "term", "left_semi"), "lists")
    frequency = lists.groupBy("term").agg(F.sum("n").alias("total"))
    windows = _windows(items, frequency, width)
    asked = windows.join(lists.select("segment", "term"), "term").groupBy("segment", "item")
    asked = asked.agg(F.collect_list(F.struct("start", "offset")).alias("w"))
    asked = asked.join(items, "item").select(
        "segment", "item_id", "terms", F.col("w.start").alias("starts"), F.col("w.offset").alias("offsets")
    )
    starts = listed.where(F.col("term") == STARTS).join(lists.select("segment").distinct(), "segment", "left_semi")
    there = lists.unionByName(starts.select(*lists.columns))
    function = partial(_matched, width=width, slack=slack)
    return there.groupBy("segment").cogroup(asked.groupBy("segment")).applyInArrow(
        lambda a, b: function(a, b), _MATCH_DDL
    )


def documents(indexed: DataFrame) -> DataFrame:
    """One row for each indexed document: segment, ordinal, n_words and its keys."""
    return indexed.where("term IS NULL").drop("term", "n", "postings")


def contamination(indexed: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every document with its keys, ``n_words``, ``n_hit`` (words inside any occurring window) and ``items``.

    The words of items without an id are in n_hit, but nothing is listed for them.
    """
    found = matches(indexed, benchmark, width).where("kind = 'exact'")
    found = staged(found.select("segment", "ordinal", "item_id", "start", "length"), "matches")
    hit = found.select("segment", "ordinal", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("word"))
    hit = hit.distinct().groupBy("segment", "ordinal").agg(F.count(F.lit(1)).alias("n_hit"))
    items = found.groupBy("segment", "ordinal").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    rows = documents(indexed).join(hit, ["segment", "ordinal"], "left").join(items, ["segment", "ordinal"], "left")
    return rows.withColumns(
        {"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", F.array().cast("array<string>"))}
    ).drop("segment", "ordinal")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` without the rows whose text holds a window of the benchmark."""

    def clean(given: DataFrame, column: str) -> DataFrame:
        name = {"text_hash__": F.xxhash64(column), "text_size__": F.length(column)}
        marked = given.withColumns(name)
        hit = contamination(index(marked.select(*name, column), list(name), column), benchmark, width).where("n_hit > 0")
        return marked.join(hit.select(*name).distinct(), list(name), "left_anti")

    return under_own_names(docs, clean, text)

"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillflow.llm.graph import components
from tillflow.llm.text import NOT_BLANK, slices, words
from tillflow.llm.work import arrow_map, under_own_names
from tillflow.sources.staging import staged

BITS = 64
CHUNK = 1 << 17  # shingles whose bits are counted at a time


def fingerprints(texts: pa.Array, width: int, seed: int = 42) -> np.ndarray:
    """Unsigned fingerprint of each text; zero where it has no words."""
    split = words(texts, NOT_BLANK)
    buffer, begin, end = split.joined()
    count = split.counts()
    shingles = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    before = np.cumsum(shingles) - shingles
    row = np.repeat(np.arange(len(count)), shingles)
    head = split.first[:-1][row] + np.arange(len(row)) - before[row]
    tail = np.minimum(head + width, split.first[1:][row]) - 1
    ones = np.zeros((len(count), BITS), np.int64)
    for low in range(0, len(row), CHUNK):
        part = slice(low, low + CHUNK)
        spans = zip(begin[head[part]].tolist(), end[tail[part]].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(buffer[a:b], seed) for a, b in spans], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        rows, at = np.unique(row[part], return_index=True)
        ones[rows] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > shingles[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _fingerprinted(batch: pa.RecordBatch, text: str, width: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, text):
        values = pa.array(fingerprints(part.column(text), width).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*(c for n, c in zip(part.schema.names, part.columns, strict=True)), values],
            [*part.schema.names, "fingerprint"],
        )


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 4, keep_text: bool = True) -> DataFrame:
    """Add ``fingerprint`` (bigint, its 64 bits read as signed); replaces a column of that name.

    Null, empty and blank texts have fingerprint 0.  Whole texts are used, however long.
    """
    docs = docs.drop("fingerprint")
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = StructType([*docs.schema.fields, StructField("fingerprint", LongType())])
    marked = arrow_map(docs, partial(_fingerprinted, text=text, width=width), schema)
    return marked.select(*(f"`{f.name}`" for f in kept), "fingerprint")


def _masks(blocks: int) -> list[int]:
    """Bit masks of ``blocks`` blocks of nearly equal width, as signed 64-bit numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(prints: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ in 1 to ``distance`` bits, each once.

    Of ``blocks`` blocks, a pair has at least ``blocks - distance`` whole ones in common, so it
    meets in the bucket of some choice of that many blocks.  It is reported in the bucket of
    its first common blocks only; the comparison is part of the join, so a crowded bucket
    costs comparisons but no rows.
    """
    kept = blocks - distance
    if kept < 1:
        raise ValueError("pairs share a block only if there are more blocks than differing bits")
    masks = _masks(blocks)
    choices = list(combinations(range(blocks), kept))

    def signed(values: tuple[int, ...]) -> int:
        total = sum(masks[i] % (1 << BITS) for i in values)
        return total - (1 << BITS) if total >> (BITS - 1) else total

    entries = F.array(
        *(
            F.struct(F.lit(n).cast("byte").alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(signed(c))).alias("bucket"))
            for n, c in enumerate(choices)
        )
    )
    spread = prints.select("fingerprint", F.inline(entries))
    left = spread.withColumnRenamed("fingerprint", "a")
    right = spread.select(F.col("fingerprint").alias("b"), F.col("choice").alias("c2"), F.col("bucket").alias("b2"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    # Blocks before the last chosen one that were not chosen must differ, else an earlier choice reports the pair.
    passed_over = F.array(
        *(F.lit(sum(1 << i for i in range(c[-1]) if i not in c)) for c in choices)
    )[F.col("choice").cast("int")]

    def first_choice() -> Column:
        tests = [
            (passed_over.bitwiseAND(F.lit(1 << i)) == 0) | (differing.bitwiseAND(F.lit(m)) != 0)
            for i, m in enumerate(masks)
        ]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out

    met = (
        (F.col("choice") == F.col("c2"))
        & (F.col("bucket") == F.col("b2"))
        & (F.col("a") < F.col("b"))
        & (F.bit_count(differing) <= distance)
        & first_choice()
    )
    return left.join(right, met).select("a", "b")


def groups(prints: DataFrame, id_column: str = "doc_id", distance: int = 4, blocks: int = 6) -> DataFrame:
    """``fingerprint``, ``root``, ``component_id`` and ``keeper`` for each distinct fingerprint.

    prints: columns ``fingerprint`` and ``id_column``, one row for each document.  component_id
    is the smallest id of the component, null if all its ids are null; keeper is the
    fingerprint under which that id occurs (the smallest, should there be several).
    """
    distinct = staged(prints.groupBy("fingerprint").agg(F.min(id_column).alias("least")), "prints")
    roots = components(links(distinct.select("fingerprint"), distance, blocks))
    placed = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    placed = placed.withColumn("root", F.coalesce("root", "fingerprint"))
    order = F.struct(F.col("least").isNull(), F.col("least"), F.col("fingerprint"))
    best = placed.groupBy("root").agg(F.min(order).alias("best"))
    return placed.join(best, "root").select(
        "fingerprint", "root", F.col("best.least").alias("component_id"), F.col("best.fingerprint").alias("keeper")
    )


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4, blocks: int = 6
) -> DataFrame:
    """Fingerprint and component of every row of ``docs``, null ids and repeated rows included."""
    marked = staged(with_fingerprint(docs.select(id_column, text), text, width, keep_text=False), "fingerprints")
    found = groups(marked, id_column, distance, blocks).select("fingerprint", "component_id")
    return marked.join(found, "fingerprint")


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4, blocks: int = 6
) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that with the smallest id.

    Of repeated rows one stays.  Documents without words form one component.
    """
    return under_own_names(
        docs, lambda given, i, t: _deduplicated(given, i, t, width, distance, blocks), id_column, text
    )


# What names a row: its text by hash and size, and its id as a text that is never null.
NAME = ["hash__", "size__", "key__"]


def _deduplicated(docs: DataFrame, id_column: str, text: str, width: int, distance: int, blocks: int) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    key = F.coalesce(F.concat(F.lit("1"), F.col(id_column).cast("string")), F.lit("0"))
    named = docs.withColumns({"hash__": F.xxhash64(whole), "size__": F.octet_length(whole), "key__": key})
    narrow = named.select(F.col(id_column).alias("id__"), *NAME, F.col(text).alias("text__"))
    marked = staged(with_fingerprint(narrow, "text__", width, keep_text=False), "fingerprints")
    kept = _keepers(marked, groups(marked, "id__", distance, blocks))
    # Both want the rows by the same columns, so the texts are shuffled once, repeated rows put together before.
    return named.dropDuplicates(NAME).join(kept, NAME, "left_semi")


def _keepers(marked: DataFrame, found: DataFrame) -> DataFrame:
    """Name of the row that stays of each component, from ``groups``.

    It is one of the keeper's fingerprint under the smallest id, so neither the texts nor
    their fingerprints are stored or made again.
    """
    kept = found.where("fingerprint = keeper").select("fingerprint", F.col("component_id").alias("id__"))
    same = (marked["fingerprint"] == kept["fingerprint"]) & marked["id__"].eqNullSafe(kept["id__"])
    named = marked.join(kept, same, "left_semi").groupBy("fingerprint")
    return named.agg(F.min(F.struct(*NAME)).alias("kept")).select("kept.*")

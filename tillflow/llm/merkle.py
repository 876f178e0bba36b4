"""Merkle manifest of a table: a persistent tree by path copying, built and proved in aligned blocks.

Each group (a source, say) has a tree of its own over its rows in order, and the roots of
the groups make the tree on top.  ``WAYS`` consecutive nodes have one parent.  A task works on
blocks of ``WAYS ** LEVELS`` consecutive nodes, whose edges are edges of subtrees on every
level; the nodes above the blocks make blocks of the next tier, until one node is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.ranking import placed
from tillflow.llm.work import arrow_map
from tillflow.sources.staging import staged

WAYS, LEVELS = 16, 3
DIGEST = 64  # characters of a digest; hashed as such, stored as half as many bytes
STEPS = "array<struct<before binary, after binary>>"


def leaf(*values: Column) -> Column:
    """Digest (binary) of values: ``-`` for null, else the UTF-8 bytes, a colon and the value's text."""
    parts = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in (v.cast("string") for v in values)
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Tree:
    """The nodes over one block, bottom up; a version copies the path of one leaf and shares the rest."""

    def __init__(self, digests: list[bytes], whole: bool, levels: int):
        """whole: the block is all of its group, so its tree ends at one node."""
        self.runs: list[list[bytes]] = []  # by level, what each parent is the digest of
        nodes = digests
        while len(nodes) > 1 if whole else len(self.runs) < levels:
            self.runs.append([b"".join(nodes[i : i + WAYS]) for i in range(0, len(nodes), WAYS)])
            nodes = [sha256(run).hexdigest().encode() for run in self.runs[-1]]
        self.root = nodes[0]

    def steps(self, place: int) -> list[tuple[bytes, bytes]]:
        """The siblings before and after each node on the way up from a leaf."""
        out = []
        for level in self.runs:
            run, at = level[place // WAYS], place % WAYS * DIGEST
            out.append((run[:at], run[at + DIGEST :]))
            place //= WAYS
        return out


def copied(digest: bytes, steps: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The ancestors that a version has of its own if a leaf becomes ``digest``."""
    out = []
    for before, after in steps:
        digest = sha256(before + digest + after).hexdigest().encode()
        out.append(digest)
    return out


def _hex(values: pa.Array) -> list[bytes]:
    return [v.hex().encode() for v in values.to_pylist()]


def _blocks(batch: pa.RecordBatch, levels: int) -> Iterator[tuple[int, pa.StructArray, Tree]]:
    """Each row of a tier: its number, its nodes in order, and their tree."""
    for i, (number, nodes) in enumerate(zip(batch.column("block").to_pylist(), batch.column("nodes"), strict=True)):
        nodes = nodes.values
        nodes = nodes.take(pc.sort_indices(nodes.field("place")))
        yield i, nodes, Tree(_hex(nodes.field("digest")), number == 0 and len(nodes) < WAYS**levels, levels)


def _rooted(batch: pa.RecordBatch, levels: int) -> Iterator[pa.RecordBatch]:
    roots = [bytes.fromhex(tree.root.decode()) for _, _, tree in _blocks(batch, levels)]
    names = ["grp", "place", "digest"]
    yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("block"), pa.array(roots, pa.binary())], names)


def _above(batch: pa.RecordBatch, i: int) -> list[tuple[bytes, bytes]]:
    return [(s["before"].hex().encode(), s["after"].hex().encode()) for s in batch.column("steps")[i].as_py()]


def _descended(batch: pa.RecordBatch, levels: int) -> Iterator[pa.RecordBatch]:
    """The way up from each node of a tier's blocks, continued by the way up from its block."""
    for i, nodes, tree in _blocks(batch, levels):
        above = batch.column("steps")[i].as_py()
        ways = [
            [{"before": bytes.fromhex(b.decode()), "after": bytes.fromhex(a.decode())} for b, a in tree.steps(place)] + above
            for place in range(len(nodes))
        ]
        kind = batch.schema.field("steps").type
        size = len(nodes)
        first = batch.column("block")[i].as_py() * WAYS**levels
        columns = [
            pa.array([batch.column("grp")[i].as_py()] * size, pa.string()),
            pa.array(range(first, first + size), pa.int64()),
            nodes.field("digest"),
            pa.array(ways, kind),
            pa.array([batch.column("subroot")[i].as_py()] * size, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["grp", "place", "digest", "steps", "subroot"])


def _proved(batch: pa.RecordBatch, levels: int, versions: bool) -> Iterator[pa.RecordBatch]:
    """Proof and version of every leaf of the lowest tier's blocks."""
    for i, nodes, tree in _blocks(batch, levels):
        above = _above(batch, i)
        beyond = b"".join(b + a for b, a in above)
        claims = nodes.field("claim").to_pylist()
        proofs, folded, copies = [], [], []
        for place, (own, claim) in enumerate(zip(_hex(nodes.field("digest")), claims, strict=True)):
            steps = tree.steps(place)
            proofs.append(sha256(b"".join(b + a for b, a in steps) + beyond).digest())
            digest = own if claim is None else claim.hex().encode()
            path = copied(digest, steps + above)
            folded.append(bytes.fromhex((path or [digest])[-1].decode()))
            if versions:
                copies.append(None if claim is None else [bytes.fromhex(p.decode()) for p in path])
        size = len(nodes)
        columns = [
            nodes.field("key"),
            nodes.field("digest"),
            pa.array([batch.column("subroot")[i].as_py()] * size, pa.binary()),
            pa.array(proofs, pa.binary()),
            pa.array(folded, pa.binary()),
            *([pa.array(copies, pa.list_(pa.binary()))] if versions else []),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["key", "leaf", "subroot", "proof", "folded", *["copies"] * versions])


def _tier(nodes: DataFrame, levels: int, *carried: str) -> DataFrame:
    """Nodes gathered into blocks, which are small, so no group is gathered whole."""
    size = WAYS**levels
    node = F.struct((F.col("place") % size).cast("int").alias("place"), "digest", *carried)
    block = F.floor(F.col("place") / size).cast("bigint")
    return staged(nodes.groupBy("grp", block.alias("block")).agg(F.collect_list(node).alias("nodes")), "blocks")


def _tiers(lowest: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all tiers over ``lowest``, and the one node of each group that is left."""
    tiers = [lowest]
    while True:
        roots = staged(arrow_map(tiers[-1], partial(_rooted, levels=levels), "grp string, place bigint, digest binary"), "nodes")
        if not roots.where("place > 0").head(1):
            return tiers, roots
        tiers.append(_tier(roots, levels))


@dataclass
class Manifest:
    """The stored blocks of a tree, by tier: those of the groups, and those over the groups' roots."""

    tiers: list[DataFrame]
    top: list[DataFrame]
    names: DataFrame  # the groups in order, with their places
    root: bytes | None  # none for a table without rows
    levels: int  # of a block

    def _down(self, tiers: list[DataFrame], ways: DataFrame) -> DataFrame:
        """From the ways up from the last tier's blocks to those from the first tier's."""
        for tier in reversed(tiers):
            joined = tier.join(ways.withColumnRenamed("place", "block").drop("digest"), ["grp", "block"])
            ways = staged(arrow_map(joined, partial(_descended, levels=self.levels), f"grp string, place bigint, digest binary, steps {STEPS}, subroot binary"), "ways")
        return ways

    def proved(self, versions: bool = False) -> DataFrame:
        """A row for each row of the table: ``key``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded``, ``verified``.

        proof: digest of all siblings on the way to the root, by level from below, left to
        right.  folded: the root of the version in which the leaf is its claim, or the leaf
        itself where there is none.  versions: also ``copies``, the ancestors that the version
        of a claimed leaf has of its own, from below; on level n it is the node at place / 16^n,
        and all other nodes are those of the stored blocks.
        """
        spark = self.tiers[0].sparkSession
        start = spark.createDataFrame([("", 0)], "grp string, place bigint")
        start = start.withColumns({"steps": F.expr(f"cast(array() as {STEPS})"), "subroot": F.lit(None).cast("binary")})
        ways = self._named(self._down(self.top, start))
        ways = self._down(self.tiers[1:], ways)
        lowest = self.tiers[0].join(ways.withColumnRenamed("place", "block").drop("digest"), ["grp", "block"])
        key = next(f for f in self.tiers[0].schema["nodes"].dataType.elementType.fields if f.name == "key").dataType
        schema = f"key {key.simpleString()}, leaf binary, subroot binary, proof binary, folded binary" + ", copies array<binary>" * versions
        found = arrow_map(lowest, partial(_proved, levels=self.levels, versions=versions), schema).withColumn("root", F.lit(self.root))
        return found.withColumn("verified", F.col("folded") == F.col("root"))

    def _named(self, ways: DataFrame) -> DataFrame:
        """The ways up from the groups' roots, under the groups' names."""
        names = self.names.select(F.col("grp").alias("name"), "place")
        found = ways.drop("grp").join(names, "place")
        return found.select(F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("place"), "steps", F.col("digest").alias("subroot"))


def manifest(rows: DataFrame, group: str, order: list[str], keys: list[str], levels: int = LEVELS) -> Manifest:
    """The tree over ``rows``, which have ``leaf`` (binary digest) and may have ``claim`` (another digest of the row, or null).

    Rows of a group ascend by ``order`` (nulls first) and then by leaf; groups ascend by the
    UTF-8 bytes of their name, null first.  Repeated rows are leaves each.  keys: columns handed
    through to :meth:`Manifest.proved` as the struct ``key``; no other columns are looked at, so
    their names don't matter.  A table without rows has no root, and no proofs.
    """
    name = F.coalesce(F.concat(F.lit("1"), rows[f"`{group}`"].cast("string")), F.lit("0"))
    claim = rows["claim"] if "claim" in rows.columns else F.lit(None).cast("binary")
    narrow = rows.select(
        name.alias("grp"),
        *(rows[f"`{c}`"].alias(f"order{i}") for i, c in enumerate(order)),
        rows["leaf"].alias("digest"),
        claim.alias("claim"),
        F.struct(*(rows[f"`{k}`"].alias(k) for k in keys)).alias("key"),
    )
    sequence = [f"order{i}" for i in range(len(order))]
    ranked = placed(staged(narrow, "leaves"), ["grp"], [*sequence, "digest"]).drop(*sequence)
    tiers, subroots = _tiers(_tier(ranked, levels, "claim", "key"), levels)
    names = placed(subroots.select("grp", "digest"), [], ["grp"], "subroots")
    top, root = _tiers(_tier(names.select(F.lit("").alias("grp"), "digest", "place"), levels), levels)
    found = root.first()
    return Manifest(tiers, top, names, bytes(found["digest"]) if found else None, levels)

"""Connected components of an undirected graph in alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.sources.staging import staged

FLUSH_EDGES = 1 << 18
SALTS = 16


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a part of the graph as stars around the smallest node of each component.

    Stars of at most ``FLUSH_EDGES`` edges are made at a time, so memory is bounded; what
    is left between them is the work of the star steps.
    """

    def stars(parent: dict[int, int]) -> pa.RecordBatch:
        nodes = [n for n in parent if parent[n] != n]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([find(parent, n) for n in nodes], pa.int64())], ["a", "b"]
        )

    def find(parent: dict[int, int], node: int) -> int:
        root = node
        while parent[root] != root:
            root = parent[root]
        while parent[node] != root:
            parent[node], node = root, parent[node]
        return root

    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(parent, a), find(parent, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= FLUSH_EDGES:
            yield stars(parent)
            parent = {}
    if parent:
        yield stars(parent)


def _star(pairs: DataFrame) -> DataFrame:
    """Link every neighbour ``v`` of ``u`` to the smallest of u and its neighbours.

    The neighbours of a hot centre are dealt to ``SALTS`` tasks; its minimum goes to each.
    """
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(least, ["u", "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    edges: bigint columns ``a`` and ``b``, neither null; loops and repeated edges do no harm.
    Returns ``node`` and ``root``, one row for each node.  Rounds of a large and a small star
    step until nothing changes: at most about log2 of the longest path squared, mostly two or
    three, as each part of the edges is first contracted where it lies.  The edges of a round
    are written to the shared folder; hot centres are pre-aggregated, and salted in their join.
    """
    now = staged(edges.select("a", "b").where("a <> b").mapInArrow(_forest, "a bigint, b bigint"), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # All pairs now have u > v, as the small step needs them.
        small = _star(large.where("u <> v").distinct())
        links = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select("u", "m"))
        now = staged(links.where("a <> b").distinct(), "edges")

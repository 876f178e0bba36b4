"""Near-duplicate embeddings by counting collisions in many sorted one-dimensional projections.

Unit vectors are projected on random directions.  Two vectors collide in a projection if one
lies in the window centred at the other; from the cosine at which pairs must be found, the
collisions of such a pair are binomial, and the least count is set so that it is reached with
the wanted recall.  Pairs that reach it are verified in double precision.

The vectors are range-sorted by one more projection and kept in blocks, each with all its
projections sorted.  A block's vectors are queries to the blocks whose range comes within the
same recall of their own: a window is a run of a sorted projection, found by binary search,
and the runs of a query are counted together.  Windows of single projections can't tell
vectors apart well enough for less work than a fixed share of all pairs of distinct vectors
(near pairs collide at most sqrt((1 - 0) / (1 - cosine)) times as often as unrelated ones);
copies are put together before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.files import mapped, qualified, written
from tillflow.llm.graph import components
from tillflow.llm.ranking import placed
from tillflow.llm.work import arrow_map, new_folder
from tillflow.sources.staging import staged

PROJECTIONS = 40
STEP, REACH = 1 / 4096, 1843  # width of a code, and codes that a window goes to either side (0.45 in all)
RECALL = 0.9995
BLOCK = 4096  # vectors, at most 65,536
PAIRS = 8  # of blocks that a task compares
LEAST_LENGTH, MOST_LENGTH = 1e-100, 1e100
SEED = 20_240_501


@lru_cache(maxsize=4)
def directions(dimension: int, count: int = PROJECTIONS) -> np.ndarray:
    """Normal directions, the first of them for sorting."""
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, count + 1))


def collision_rate(cosine: float) -> float:
    """How often the codes of two unit vectors with this cosine lie within ``REACH`` of each other."""
    t = np.linspace(0, REACH + 1, 20_001)
    scale = sqrt(2 * (1 - cosine)) / STEP
    density = np.exp(-0.5 * (t / scale) ** 2) * 2 / (scale * sqrt(2 * np.pi))
    return float(np.trapezoid(density * np.clip(REACH + 1 - t, 0, 1), t))


@lru_cache(maxsize=4)
def least_count(cosine: float, count: int = PROJECTIONS, recall: float = RECALL) -> int:
    """The largest count that pairs of this cosine reach with probability ``recall``."""
    rate, reached, least = collision_rate(cosine), 1.0, 0
    for k in range(count + 1):
        if reached < recall:
            break
        least = k
        reached -= comb(count, k) * rate**k * (1 - rate) ** (count - k)
    return least


def sort_window(cosine: float, recall: float = RECALL) -> float:
    """Distance in the sorting projection that pairs of this cosine exceed in ``1 - recall`` of cases."""
    low, high = 0.0, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if erf(middle / sqrt(2)) < recall else (low, middle)
    return high * sqrt(2 * (1 - cosine))


def _usable(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The vector as bytes of doubles; null where it can't link."""
    vectors = batch.column("embedding")
    values = [None] * batch.num_rows
    for i, vector in enumerate(vectors):
        if vector.is_valid and len(vector.values) and not vector.values.null_count:
            numbers = vector.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            largest = np.abs(numbers).max()
            if not np.isfinite(largest) or largest == 0:
                continue
            if not LEAST_LENGTH < largest < MOST_LENGTH:  # whose squares leave the range of doubles
                numbers = numbers / largest
            values[i] = numbers.tobytes()
    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(values, pa.binary())], ["vec_id", "vector"])


def _projected(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    raws = batch.column("vector").to_pylist()
    sizes = np.array([len(r) // 8 for r in raws])
    at, first = [None] * len(raws), np.zeros(len(raws))
    for dimension in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dimension)
        vectors = np.frombuffer(b"".join(raws[i] for i in rows), np.float64).reshape(-1, dimension)
        vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        found = vectors @ directions(dimension)
        codes = np.clip(np.floor(found[:, 1:] / STEP), -32768, 32767).astype(np.int16)
        first[rows] = found[:, 0]
        for i, c, v in zip(rows.tolist(), codes, vectors, strict=True):
            at[i] = (c.tobytes(), v.tobytes())
    codes, units = zip(*at, strict=True)
    names = ["node", "copies", "dimension", "sort", "codes", "unit"]
    yield pa.RecordBatch.from_arrays(
        [batch.column("node"), batch.column("copies"), pa.array(sizes, pa.int32()), pa.array(first), pa.array(codes, pa.binary()), pa.array(units, pa.binary())],
        names,
    )


_BLOCK = "block bigint, dimension int, low double, high double, names array<string>"


def _written_block(rows: pa.Table, folder: str) -> pa.Table:
    """Write the vectors of a block as arrays, with all its projections sorted."""
    rows = rows.sort_by("place")
    dimension = rows["dimension"][0].as_py()
    units = np.frombuffer(b"".join(rows["unit"].to_pylist()), np.float64).reshape(-1, dimension)
    codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.int16).reshape(-1, PROJECTIONS).T
    order = np.argsort(codes, axis=1, kind="stable")
    sort = rows["sort"].to_numpy()
    names = [
        written(folder, "nodes", rows["node"].to_numpy()), written(folder, "copies", rows["copies"].to_numpy()),
        written(folder, "codes", codes), written(folder, "sorted", np.take_along_axis(codes, order, axis=1)),
        written(folder, "order", order.astype(np.uint16)), written(folder, "units", units),
    ]
    types = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.string()))
    values = [rows["block"][0].as_py(), dimension, sort[0], sort[-1], names]
    return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], ["block", "dimension", "low", "high", "names"])


@dataclass(frozen=True)
class _Block:
    nodes: np.ndarray
    copies: np.ndarray
    codes: np.ndarray  # by projection
    sorted: np.ndarray  # the same in order
    order: np.ndarray  # which vector each of these is of
    units: np.ndarray


@lru_cache(maxsize=4)
def _block(folder: str, names: tuple[str, ...], dimension: int) -> _Block:
    kinds = (np.int64, np.int64, np.int16, np.int16, np.uint16, np.float64)
    arrays = [mapped(folder, n, k) for n, k in zip(names, kinds, strict=True)]
    by_projection = [a.reshape(PROJECTIONS, -1) for a in arrays[2:5]]
    return _Block(*arrays[:2], *by_projection, arrays[5].reshape(-1, dimension))


def _collided(one: _Block, two: _Block, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each vector of ``one`` as a query, and the vectors of ``two`` that lie in ``least`` of its windows."""
    codes = one.codes.astype(np.int32)
    low = np.stack([np.searchsorted(s, c - REACH, "left") for s, c in zip(two.sorted, codes, strict=True)], axis=1).tolist()
    high = np.stack([np.searchsorted(s, c + REACH, "right") for s, c in zip(two.sorted, codes, strict=True)], axis=1).tolist()
    order, size = list(two.order.astype(np.int64)), two.order.shape[1]
    for query, (begins, ends) in enumerate(zip(low, high, strict=True)):
        runs = [o[a:b] for o, a, b in zip(order, begins, ends, strict=True)]
        yield query, np.flatnonzero(np.bincount(np.concatenate(runs), minlength=size) >= least)


def _compared(batch: pa.RecordBatch, folder: str, cosine: float) -> Iterator[pa.RecordBatch]:
    """Links of two blocks: how many vectors each is linked to (b null), and edges that span them."""
    least = least_count(cosine)
    for pair in batch.to_pylist():
        one = _block(folder, tuple(pair["names"]), pair["dimension"])
        two = _block(folder, tuple(pair["names2"]), pair["dimension"])
        same = pair["names"] == pair["names2"]
        n, m = len(one.nodes), len(two.nodes)
        links = [np.zeros(n, np.int64), np.zeros(m, np.int64)]
        root = np.arange(n if same else n + m)
        other = 0 if same else n
        for query, candidates in _collided(one, two, least):
            # Products are added up in the same order whichever of the two asks.
            linked = candidates[(two.units[candidates] * one.units[query]).sum(axis=1) >= cosine]
            if same:
                linked = linked[linked != query]
            if not len(linked):
                continue
            links[0][query] += two.copies[linked].sum()
            if not same:
                links[1][linked] += one.copies[query]
            met = np.unique(root[np.append(other + linked, query)])
            if len(met) > 1:
                root[np.isin(root, met)] = met[0]
        nodes = one.nodes if same else np.concatenate([one.nodes, two.nodes])
        joined = np.flatnonzero(root != np.arange(len(root)))
        every = links[0] if same else np.concatenate(links)
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([nodes[joined], nodes[some]])),
                pa.concat_arrays([pa.array(nodes[root[joined]]), pa.nulls(len(some), pa.int64())]),
                pa.concat_arrays([pa.nulls(len(joined), pa.int64()), pa.array(every[some])]),
            ],
            ["a", "b", "links"],
        )


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors within ``cosine``), ``component_id`` and ``kept`` for every row.

    vectors: ``vec_id`` and ``embedding``.  Rows with a null or empty vector, a null or
    non-finite component or no length link with nothing; vectors of other dimensions are not compared.
    component_id is the smallest vec_id reachable by links, itself included; kept: it is the
    own one.  Repeated rows count as vectors of their own; a null vec_id is never the smallest
    and has component null unless linked.  Equal vectors are one until the end: no pairs of copies.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["vec_id"]
    usable = arrow_map(vectors.select("vec_id", "embedding"), _usable, f"vec_id {kind}, vector binary")
    rows = usable.withColumn("key", F.sha2("vector", 256))
    copies = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")
    )
    distinct = staged(copies.withColumn("node", F.monotonically_increasing_id()), "vectors")
    folder = qualified(spark, new_folder(spark, "blocks"))
    projected = arrow_map(
        distinct.select("node", "copies", "vector"), _projected,
        "node bigint, copies bigint, dimension int, sort double, codes binary, unit binary",
    )
    # Blocks are cut by place, so they are full whatever the number of tasks.
    ordered = placed(staged(projected, "projected"), ["dimension"], ["sort", "node"], "ordered")
    ordered = ordered.withColumn("block", F.floor(F.col("place") / BLOCK).cast("bigint"))
    blocks = ordered.groupBy("dimension", "block").applyInArrow(lambda rows: _written_block(rows, folder), _BLOCK)
    blocks = staged(blocks, "blocks")
    others = blocks.select("dimension", *(F.col(c).alias(f"{c}2") for c in ("block", "low", "high", "names")))
    reach = sort_window(cosine)
    pairs = blocks.join(others, "dimension").where(
        (F.col("block") <= F.col("block2")) & (F.col("low2") <= F.col("high") + reach) & (F.col("high2") >= F.col("low") - reach)
    )
    n_pairs = max(1, blocks.count() * (blocks.count() + 1) // 2)
    dealt = pairs.select("dimension", "names", "names2").repartition(-(-n_pairs // PAIRS), F.xxhash64("names", "names2"))
    found = staged(arrow_map(dealt, partial(_compared, folder=folder, cosine=cosine), "a bigint, b bigint, links bigint"), "links")
    linked = found.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    found_of = distinct.select("key", "node", "copies", "least").join(linked, "node", "left").join(roots, "node", "left")
    found_of = found_of.withColumn("root", F.coalesce("root", "node"))
    named = found_of.groupBy("root").agg(F.min("least").alias("component"))
    found_of = found_of.join(named, "root").select("key", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = rows.select("vec_id", "key").join(found_of, "key", "left")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Places of rows in their groups, by one range sort: no group, however large, meets in one task."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.sources.staging import staged

PART, INDEX, RUN, ROW = "part__", "index__", "run__", "row__"


def _numbered(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.RecordBatch]:
    """The task, the row's number in it, and its number in the run of its group there."""
    part, index, began, last = TaskContext.get().partitionId(), 0, 0, None
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        changed = pa.array([False] * (size - 1), pa.bool_())
        for name in group:
            a, b = batch.column(name).slice(0, size - 1), batch.column(name).slice(1)
            differs = pc.or_(pc.xor(pc.is_null(a), pc.is_null(b)), pc.fill_null(pc.not_equal(a, b), False))
            changed = pc.or_(changed, differs)
        first = [batch.column(name)[0].as_py() for name in group]
        if last is not None and first != last:
            began = index
        last = [batch.column(name)[size - 1].as_py() for name in group]
        runs, number = [], index
        for new in [False, *changed.to_pylist()]:
            if new:
                began = number
            runs.append(number - began)
            number += 1
        columns = [pa.array([part] * size, pa.int32()), pa.array(range(index, number), pa.int64()), pa.array(runs, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, PART, INDEX, RUN])
        index = number


def placed(rows: DataFrame, group: list[str], order: list[str], label: str = "placed") -> DataFrame:
    """``rows`` with ``place``: 0, 1, 2 ... in each group by ``order``, ascending, nulls first.

    rows should be a stored table, as sorting reads it twice.  Rows that are equal in all of
    these columns get consecutive places in any order, and may lie in several tasks.  What
    comes back is stored in the shared folder.  The driver sees one line for each task.
    group: columns that Python can compare; an empty list numbers all rows.
    """
    # The number of a scanned row is the same if a lost task is repeated, and splits equal rows.
    keys = [*group, *order, ROW]
    ranged = rows.withColumn(ROW, F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(ROW)
    schema = ", ".join([*(f"`{n}` {t}" for n, t in ranged.dtypes), f"{PART} int, {INDEX} bigint, {RUN} bigint"])
    numbered = staged(ranged.mapInArrow(partial(_numbered, group=group), schema), label)
    key = F.struct(*group, F.lit(0))
    ends = numbered.groupBy(PART).agg(
        F.count(F.lit(1)).alias("size"),
        F.max(F.when(F.col(INDEX) == F.col(RUN), F.col(RUN) + 1)).alias("head"),
        F.max_by(F.col(RUN) + 1, INDEX).alias("tail"),
        F.min_by(key, INDEX).alias("first"),
        F.max_by(key, INDEX).alias("last"),
    )
    before, carried, last = [], 0, None
    for end in sorted(ends.collect(), key=lambda e: e[PART]):
        begun = carried if last == end["first"] else 0
        before.append((end[PART], begun))
        carried, last = (begun + end["size"] if end["head"] == end["size"] else end["tail"]), end["last"]
    known = rows.sparkSession.createDataFrame(before, f"{PART} int, before__ bigint")
    # At most one row for each task of the sort.
    joined = numbered.join(F.broadcast(known), PART, "left")
    begun = F.when(F.col(INDEX) == F.col(RUN), F.col("before__")).otherwise(0)
    return joined.withColumn("place", F.col(RUN) + begun).select(*(f"`{c}`" for c in rows.columns), "place")

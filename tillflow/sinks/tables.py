"""Partitioned table writes."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    table_format: str = "parquet",
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace the whole table.  finish: adds columns to the rows when they have been laid out."""
    _laid_out(df, partition_by, sort_by, finish).write.format(table_format).mode("overwrite").partitionBy(
        *partition_by
    ).save(path)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (), laid_out: bool = False
) -> None:
    """Replace the partitions that have rows in ``df``; the others stay.

    laid_out: ``df`` reads a table that :func:`overwrite` wrote with the same ``partition_by``; its files
    hold one partition each, sorted, so a task that reads them writes them into their own partitions
    and they go over without being shuffled again.
    """
    (
        (df if laid_out else _laid_out(df, partition_by, sort_by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _laid_out(
    df: DataFrame,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Few well-filled files per partition, sorted for min/max skipping.

    Rebalancing lets adaptive execution cut a large month or region into several
    tasks and join small ones, where a plain repartition would hand each
    partition to one task.
    """
    finish = finish or (lambda rows: rows)
    if not partition_by:
        return finish(df.orderBy(*sort_by) if sort_by else df)
    sort_by = [*partition_by, *[c for c in sort_by if c not in partition_by]]
    return finish(df.hint("rebalance", *[F.col(c) for c in partition_by]).sortWithinPartitions(*sort_by))

"""Keyed upsert into a partitioned table."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from tillflow.operators.merge import merged
from tillflow.schemas import RECENCY, TIE_BREAK
from tillflow.sinks import directory
from tillflow.sinks.tables import overwrite, overwrite_partitions
from tillflow.sources.lake import in_partitions, stored
from tillflow.sources.staging import cleared, remove, staged

_STATE = StructType().add("state", "string")


def upsert(
    incoming: DataFrame,
    path: str,
    key: str,
    partition_by: Sequence[str],
    table_format: str = "parquet",
    recency: str = RECENCY,
    tie_break: Sequence[str] = TIE_BREAK,
    log: Callable[[DataFrame], None] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Insert new keys, replace stored rows that are not more recent; ``incoming`` has unique keys.

    Delta does this as one MERGE.  Parquet has no transactions, so the new
    content of the touched partitions is completed beside the table first and
    then swapped in.  An interrupted swap is finished by the next call (or by
    :func:`recover`), because it only repeats the same overwrite.  One writer at
    a time; a reader during the swap may see a row in its old and new partition.

    log: gets the incoming rows and the stored versions of their keys, before
    anything is swapped in; not called for the first rows of a table.  Rows that are
    stored already, or older than what is, may be left out, as they change nothing.
    finish: adds columns that follow from others of the row.  They are left out of ``incoming``
    and made when it is written, so that no shuffle carries them.
    """
    spark = incoming.sparkSession
    finish = finish or (lambda rows: rows)
    schema = finish(incoming).schema
    if table_format == "delta":
        with cleared(spark):
            _merge_into_delta(finish(incoming), path, key, partition_by, recency, tie_break, log)
        return
    _require_integral(incoming, partition_by)
    recover(spark, path, schema, partition_by, key)
    current = stored(spark, path, schema)
    if current is None:
        directory.forget(spark, path)
        with cleared(spark):  # what made the rows is off the disk before they are shuffled once more
            overwrite(staged(incoming, "upsert"), path, partition_by, [key], finish=finish)
        return
    with cleared(spark):
        _prepare(staged(incoming, "upsert"), current, path, key, partition_by, recency, tie_break, log, finish)
    _set_state(spark, path, "publishing")
    _publish(spark, path, schema, partition_by, key)


def _prepare(
    incoming: DataFrame,
    current: DataFrame,
    path: str,
    key: str,
    partition_by: Sequence[str],
    recency: str,
    tie_break: Sequence[str],
    log: Callable[[DataFrame], None] | None,
    finish: Callable[[DataFrame], DataFrame],
) -> None:
    """Write the new content of all touched partitions beside the table."""
    spark = incoming.sparkSession
    keys, buckets = directory.opened(current, path, key, partition_by)
    living = directory.residence(keys, buckets, incoming, key).select(*partition_by).distinct()
    made = [c for c in current.columns if c not in incoming.columns]
    compared = [*dict.fromkeys([*partition_by, *tie_break, *made])]
    incoming = _changing(incoming, current.filter(in_partitions(living.collect(), partition_by)), key, recency, compared, finish)
    # Partitions that receive rows, and those the keys live in now: a corrected date moves a row.
    living = directory.residence(keys, buckets, incoming, key).select(*partition_by)
    touched = incoming.select(*partition_by).union(living).distinct()
    touched.write.mode("overwrite").parquet(_pending(path, "touched"))
    touched = spark.read.parquet(_pending(path, "touched"))

    affected = current.filter(in_partitions(touched.collect(), partition_by)).select(*incoming.columns)
    if log:
        log(affected.join(incoming.select(key), key, "left_semi").unionByName(incoming))
    rows = staged(merged(affected, incoming, key, recency, tie_break), "merged")
    overwrite(rows, _pending(path, "rows"), partition_by, [key], finish=finish)
    placed = stored(spark, _pending(path, "rows"), current.schema).select(key, *partition_by)
    lines = directory.renewed(keys, buckets, incoming, placed, key)
    overwrite(lines, _pending(path, "keys"), [directory.BUCKET])


def _changing(
    incoming: DataFrame,
    current: DataFrame,
    key: str,
    recency: str,
    compared: Sequence[str],
    finish: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The staged rows without those that are stored already, or in a later version, if these are most of them.

    Who merges all loads again brings mostly such rows.  Keys, times and digests are shuffled to
    find them, not the rows.
    """
    stored_key, stored_time, stored_digest = "stored__key", "stored__time", "stored__digest"
    ours = finish(incoming).select(key, F.col(recency).alias("time__"), _digest(current, compared).alias("digest__"))
    theirs = current.select(
        F.col(key).alias(stored_key), F.col(recency).alias(stored_time), _digest(current, compared).alias(stored_digest)
    )
    same = F.col(stored_time).eqNullSafe(F.col("time__")) & (F.col(stored_digest) == F.col("digest__"))
    idle = F.coalesce((F.col(stored_time) > F.col("time__")) | same, F.lit(False))
    both = ours.join(theirs, F.col(key) == F.col(stored_key), "left")
    changing = staged(both.where(~idle).select(key), "changing")
    if 2 * changing.count() > incoming.count():
        return incoming
    return staged(incoming.join(changing, key, "left_semi"), "changed")


def _digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of a SHA-256 over the values, each by its length, so that equal digests are equal values."""
    kinds = dict(df.dtypes)
    texts = [(F.unix_micros(c) if kinds.get(c) == "timestamp" else F.col(c)).cast("string") for c in columns]
    told = [F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.substring(F.unhex(F.sha2(F.concat(*told), 256)), 1, 16)


def recover(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str], key: str
) -> bool:
    """Finish an upsert that stopped while swapping partitions in; True if there was one."""
    state = stored(spark, _pending(path, "state"), _STATE)
    if state is None or state.first() is None or state.first()["state"] != "publishing":
        return False
    _publish(spark, path, schema, partition_by, key)
    return True


def _publish(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str], key: str
) -> None:
    rows = stored(spark, _pending(path, "rows"), schema)
    touched = spark.read.parquet(_pending(path, "touched"))
    lines = StructType([schema[c] for c in (key, *partition_by)]).add(directory.BUCKET, "integer")
    overwrite_partitions(rows, path, partition_by, [key], True)  # laid out by _prepare
    # A partition that lost all its rows gets no files from the write above.
    emptied = touched.exceptAll(rows.select(*partition_by).distinct())
    for row in emptied.collect():
        remove(spark, "/".join([path, *(f"{c}={row[c]}" for c in partition_by)]))
    directory.publish(spark, path, stored(spark, _pending(path, "keys"), lines))
    _set_state(spark, path, "published")
    for part in ("rows", "touched", "keys"):
        remove(spark, _pending(path, part))


def _pending(path: str, part: str) -> str:
    return f"{path}__pending/{part}"


def _set_state(spark: SparkSession, path: str, state: str) -> None:
    spark.createDataFrame([(state,)], _STATE).coalesce(1).write.mode("overwrite").parquet(_pending(path, "state"))


def _require_integral(df: DataFrame, partition_by: Sequence[str]) -> None:
    for column in partition_by:
        if not isinstance(df.schema[column].dataType, IntegralType):
            raise TypeError(f"upsert partitions by whole numbers; {column} is none")


def _merge_into_delta(
    incoming: DataFrame,
    path: str,
    key: str,
    partition_by: Sequence[str],
    recency: str,
    tie_break: Sequence[str],
    log: Callable[[DataFrame], None] | None,
) -> None:
    spark = incoming.sparkSession
    current = stored(spark, path, incoming.schema, "delta")
    if current is None:
        overwrite(incoming, path, partition_by, [key], "delta")
        return
    incoming = staged(incoming, "upsert")
    old = current.join(incoming.select(key), key, "left_semi")
    if log:
        log(old.unionByName(incoming))
    touched = incoming.select(*partition_by).union(old.select(*partition_by)).distinct().collect()
    incoming.createOrReplaceTempView("tillflow_incoming")
    spark.sql(merge_statement(path, "tillflow_incoming", key, partition_by, [recency, *tie_break], touched))


def merge_statement(
    path: str, source: str, key: str, partition_by: Sequence[str], order: Sequence[str], touched: list
) -> str:
    """One MERGE over the touched partitions; the later version by all of ``order`` wins, nulls being least."""

    def version(table: str) -> str:
        return f"struct({', '.join(f'{table}.`{c}`' for c in order)})"

    place = f"concat_ws('/', {', '.join(f'kept.`{c}`' for c in partition_by)})"
    places = ", ".join(f"'{'/'.join(str(p[c]) for c in partition_by)}'" for p in touched)
    within = f" AND {place} IN ({places})" if touched else ""
    return (
        f"MERGE INTO delta.`{path}` AS kept USING {source} AS fresh "
        f"ON kept.`{key}` = fresh.`{key}`{within} "
        f"WHEN MATCHED AND {version('fresh')} >= {version('kept')} THEN UPDATE SET * "
        "WHEN NOT MATCHED THEN INSERT *"
    )

"""Where the keys of a partitioned table live, so that a merge need not look through all of it.

A side table has the partition of every key, in folders by a hash of the key.  A merge reads
the folders of its own keys only, and replaces them in its last step.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.sinks.tables import overwrite, overwrite_partitions
from tillflow.sources.lake import stored
from tillflow.sources.staging import remove

BUCKET = "bucket__"
LEAST_BUCKETS, MOST_BUCKETS = 16, 4096
BUCKET_ROWS = 1 << 20  # keys of a bucket when it is made; at four times that many the table is made anew
_STATE = StructType().add("buckets", "integer")


def _path(path: str, part: str) -> str:
    return f"{path}__keys/{part}"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _buckets(spark: SparkSession, path: str) -> int | None:
    state = stored(spark, _path(path, "state"), _STATE)
    line = state and state.first()
    return line and line["buckets"]


def opened(current: DataFrame, path: str, key: str, partition_by: Sequence[str]) -> tuple[DataFrame, int]:
    """The directory of a stored table, made from it if there is none yet; and its number of buckets."""
    spark = current.sparkSession
    buckets = _buckets(spark, path)
    if buckets is None:
        buckets = LEAST_BUCKETS
        rows = current.count()
        while buckets < MOST_BUCKETS and rows > buckets * BUCKET_ROWS:
            buckets *= 2
        keys = current.select(key, *partition_by, bucket_of(key, buckets).alias(BUCKET))
        overwrite(keys, _path(path, "rows"), [BUCKET])
        _set_state(spark, path, buckets)
    schema = StructType([current.schema[c] for c in (key, *partition_by)]).add(BUCKET, "integer")
    return stored(spark, _path(path, "rows"), schema), buckets


def residence(directory: DataFrame, buckets: int, incoming: DataFrame, key: str) -> DataFrame:
    """The directory's lines of incoming keys; only the folders of their buckets are read."""
    wanted = incoming.select(key, bucket_of(key, buckets).alias(BUCKET))
    # At most one number for each bucket.
    numbers = [r[0] for r in wanted.select(BUCKET).distinct().collect()]
    return directory.where(F.col(BUCKET).isin(numbers)).join(wanted, [key, BUCKET], "left_semi")


def renewed(directory: DataFrame, buckets: int, incoming: DataFrame, placed: DataFrame, key: str) -> DataFrame:
    """New content of the touched buckets: incoming keys where ``placed`` has them, the others as before."""
    columns = directory.columns
    wanted = incoming.select(key, bucket_of(key, buckets).alias(BUCKET))
    numbers = [r[0] for r in wanted.select(BUCKET).distinct().collect()]
    others = directory.where(F.col(BUCKET).isin(numbers)).join(wanted, [key, BUCKET], "left_anti")
    moved = placed.join(incoming.select(key), key, "left_semi").withColumn(BUCKET, bucket_of(key, buckets))
    return others.select(*columns).unionByName(moved.select(*columns))


def publish(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Swap the touched buckets in, ``rows`` as :func:`overwrite` laid them out; a table that has outgrown its buckets is made anew by the next merge."""
    overwrite_partitions(rows, _path(path, "rows"), [BUCKET], laid_out=True)
    size = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if size > 4 * BUCKET_ROWS and (_buckets(spark, path) or MOST_BUCKETS) < MOST_BUCKETS:
        forget(spark, path)


def forget(spark: SparkSession, path: str) -> None:
    """Have the next merge make the directory anew, as after changes that did not come by a merge."""
    remove(spark, _path(path, "state"))


def _set_state(spark: SparkSession, path: str, buckets: int) -> None:
    spark.createDataFrame([(buckets,)], _STATE).coalesce(1).write.mode("overwrite").parquet(_path(path, "state"))

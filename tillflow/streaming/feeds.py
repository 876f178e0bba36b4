"""Incremental feeds: new CSV files into Bronze, new Bronze rows into Silver."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.quality import rejected
from tillflow.plans.medallion import merge_into_silver, to_silver
from tillflow.schemas import BRONZE
from tillflow.sinks.loads import FILES_AT_ONCE, new_files, take_in
from tillflow.sinks.tables import overwrite_partitions
from tillflow.sources.lake import Lake
from tillflow.sources.landing import as_listing


def feed_bronze(spark: SparkSession, lake: Lake, landing: str, max_files: int = FILES_AT_ONCE) -> StreamingQuery:
    """Pick up every file of the landing folder exactly once, then stop.

    What streams is the listing of the files.  A micro-batch checks their headers, loads the
    good ones and records the others as refused, so a bad file does not hold up the feed.  A
    micro-batch that is replayed after a failure replaces what it wrote before; should the
    checkpoint be lost, the ledger still knows the files.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load = f"feed-{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        # At most max_files names.
        files = new_files(session, lake, as_listing(batch), besides=load).orderBy("path").collect()
        if files:
            take_in(session, lake, files, lake.bronze_stream, load)

    # The fixed columns of this source; the content is not read.
    listing = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return (
        listing.option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path", "length", "modificationTime")
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", lake.checkpoint("files"))
        .trigger(availableNow=True)
        .start()
    )


def feed_silver(
    spark: SparkSession, lake: Lake, strict: Iterable[str] = (), max_files: int | None = None
) -> StreamingQuery:
    """Merge the Bronze rows that arrived since the last call into Silver, then stop.

    A micro-batch that is replayed after a failure merges the same keys and
    replaces its own quarantine partition, so it leaves the same tables.
    """
    strict = tuple(strict)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        merge_into_silver(batch.sparkSession, lake, to_silver(batch, strict))
        refused = rejected(batch, strict).withColumn("batch_id", F.lit(batch_id))
        overwrite_partitions(refused, lake.quarantine_stream, ["batch_id"])

    reader = spark.readStream.schema(BRONZE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(lake.bronze_stream)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", lake.checkpoint("silver"))
        .trigger(availableNow=True)
        .start()
    )

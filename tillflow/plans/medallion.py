"""Loading, cleaning and aggregating: the operations a scheduler calls."""

import datetime
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial
from itertools import batched

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.enrich import derived, silver_rows
from tillflow.operators.quality import is_rejected, rejected
from tillflow.plans.gold import all_tables, changed_tables
from tillflow.schemas import BRONZE_PARTITIONS, DERIVED, KEY, SILVER, SILVER_PARTITIONS, TIE_BREAK
from tillflow.sinks import changes, loads
from tillflow.sinks.gold import publish
from tillflow.sinks.loads import FILES_AT_ONCE, new_files, take_in
from tillflow.sinks.tables import overwrite, overwrite_partitions
from tillflow.sinks.upsert import recover, upsert
from tillflow.sources.lake import Date, Lake, gold_versions, processed_until, read_bronze, read_gold, read_silver
from tillflow.sources.landing import list_files
from tillflow.sources.staging import cleared, remove, staged


NAMED_FILES = 1000


@dataclass(frozen=True)
class Load:
    """What a Bronze load took in; files with a wrong header are left out whole.

    ``rejected_files`` names the first ``NAMED_FILES`` of them; ``read_refused_files`` has all.
    """

    row_count: int
    rejected_files: list[str] = field(default_factory=list)


def ingest(spark: SparkSession, lake: Lake, source: str, again: bool = False) -> Load:
    """Append the CSV files at ``source`` to Bronze as they are, each once.

    Files that were loaded or refused before are passed over, unless they were replaced since
    or ``again`` asks for all.  What an interrupted call has left is taken away first.  A large
    delivery becomes several loads of ``FILES_AT_ONCE`` files.
    """
    loads.recover(spark, lake, lake.bronze)
    listing = list_files(spark, source)
    with cleared(spark):
        files = staged(listing if again else new_files(spark, lake, listing), "files")
        rows, bad = 0, []
        for part in batched(files.orderBy("path").toLocalIterator(), FILES_AT_ONCE):
            load = f"{datetime.datetime.now(datetime.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
            count, refused = take_in(spark, lake, list(part), lake.bronze, load)
            rows += count
            bad += refused[: NAMED_FILES - len(bad)]
    return Load(rows, bad)


def to_silver(bronze: DataFrame, strict: Iterable[str] = ()) -> DataFrame:
    """Silver rows of a Bronze frame, in the columns of the Silver table.

    Versions of one time are told apart by these columns alone; file and run date, of which Silver
    has none, stay out of the shuffle.
    """
    return (
        silver_rows(bronze, TIE_BREAK, strict)
        .withColumn("silver_processed_at", F.current_timestamp())
        .select(*SILVER.names)
    )


def merge_into_silver(spark: SparkSession, lake: Lake, rows: DataFrame) -> None:
    """Merge Silver rows with unique keys, and note which groups of the Gold tables they touch."""
    log = partial(changes.log, spark, lake.changes)
    upsert(
        rows.drop(*DERIVED),
        lake.silver,
        KEY,
        SILVER_PARTITIONS,
        lake.table_format,
        log=log,
        finish=lambda kept: derived(kept).select(*SILVER.names),
    )


def refresh_silver(
    spark: SparkSession, lake: Lake, since: Date | None = None, strict: Iterable[str] = ()
) -> None:
    """Merge the batch loads of Bronze into Silver and keep rejected rows with their reasons.

    All loads by default; with ``since``, those of that run date and later.  Either
    way a repeated call changes nothing: the latest version of a key wins in any
    order of calls, and the quarantine of every run date read is replaced, also by
    nothing.  What the streaming feed took in is merged by ``feed_silver``, which
    has its own quarantine.  A row that Silver has stays there if later rules would
    refuse it.  The merge counts the rows that it refuses; only if there are some is
    Bronze read again for them.
    """
    bronze = read_bronze(spark, lake, since, feed=False)
    seen = Observation("refused")
    watched = bronze.observe(seen, F.count_if(is_rejected(bronze, strict)).alias("row_count"))
    merge_into_silver(spark, lake, to_silver(watched, strict))
    refused = rejected(bronze, strict)
    if seen.get.get("row_count") == 0:
        refused = spark.createDataFrame([], refused.schema)
    if since is None:
        overwrite(refused, lake.quarantine, BRONZE_PARTITIONS)
        return
    with cleared(spark):
        refused = staged(refused, "refused")
        overwrite_partitions(refused, lake.quarantine, BRONZE_PARTITIONS)
        # One row for each day of loads: folders of days that have no rejects any more.
        day = F.col("pipeline_run_date").cast("string")
        without = bronze.select(day).distinct().exceptAll(refused.select(day).distinct())
        for row in without.collect():
            remove(spark, f"{lake.quarantine}/pipeline_run_date={row[0]}")


def refresh_gold(spark: SparkSession, lake: Lake, week_year: str = "calendar", full: bool = False) -> str:
    """Bring the four Gold tables up to Silver; returns the version that is current then.

    Only groups that merges have touched since the last publication are computed, and nothing
    is published if there are none.  All are computed the first time, for another
    ``week_year``, and with ``full``, as is needed if Silver was written otherwise than by
    :func:`merge_into_silver`.
    """
    if lake.table_format != "delta":
        recover(spark, lake.silver, SILVER, SILVER_PARTITIONS, KEY)
    silver = read_silver(spark, lake)
    until = changes.newest(spark, lake.changes)
    last = gold_versions(spark, lake).first()
    known = last and last["changes_until"] is not None and last["week_year"] == week_year
    with cleared(spark):
        if full or not known:
            return publish(spark, lake, all_tables(silver, week_year), until, week_year)
        if last["changes_until"] == until:
            return last["version"]
        touched = changes.changes_after(spark, lake.changes, last["changes_until"], until)
        tables = changed_tables(read_gold(spark, lake, last["version"]), silver, touched, week_year)
        return publish(spark, lake, tables, until, week_year)


def run(spark: SparkSession, lake: Lake, source: str, since: Date | None = None) -> Load:
    """The whole way from CSV files to Gold.

    By default Silver takes in the loads since the last run that came this far, of
    which the lake keeps a record; ``since`` names another day.
    """
    load = ingest(spark, lake, source)
    today = spark.range(1).select(F.current_date().alias("run_date")).first()["run_date"]
    refresh_silver(spark, lake, since or processed_until(spark, lake))
    refresh_gold(spark, lake)
    done = spark.range(1).select(F.lit(today).alias("run_date"), F.current_timestamp().alias("finished_at"))
    done.coalesce(1).write.mode("append").parquet(lake.progress)
    return load

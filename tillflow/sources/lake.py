"""Where the layers live, and how to read them."""

import datetime
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.gold_tables import GOLD
from tillflow.schemas import BRONZE, REASONS_FIELD, SILVER

Date = datetime.date | str


@dataclass(frozen=True)
class Lake:
    """Folders of one installation.

    ``table_format`` is ``parquet``, or ``delta`` where that package is on the
    cluster.  Batch loads and the streaming feed have a Bronze folder each: the
    file log of a streaming sink would hide files that somebody else adds.
    """

    base: str
    table_format: str = "parquet"

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/sales"

    @property
    def bronze_stream(self) -> str:
        return f"{self.base}/bronze/sales_feed"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/sales"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine/sales"

    @property
    def quarantine_stream(self) -> str:
        return f"{self.base}/quarantine/sales_stream"

    @property
    def ledger(self) -> str:
        return f"{self.base}/loads/files"

    @property
    def begun_loads(self) -> str:
        return f"{self.base}/loads/begun"

    @property
    def progress(self) -> str:
        return f"{self.base}/progress/silver"

    @property
    def changes(self) -> str:
        return f"{self.base}/silver/changes"

    @property
    def positions(self) -> str:
        return f"{self.base}/progress/followers"

    @property
    def customers(self) -> str:
        return f"{self.base}/distincts/customers"

    @property
    def customer_bitmaps(self) -> str:
        return f"{self.base}/distincts/bitmaps"

    @property
    def customer_sketches(self) -> str:
        return f"{self.base}/distincts/sketches"

    @property
    def gold_readers(self) -> str:
        return f"{self.base}/gold/readers"

    @property
    def gold_versions(self) -> str:
        return f"{self.base}/gold/versions"

    def gold(self, version: str, table: str) -> str:
        return f"{self.base}/gold/{table}/version={version}"

    def checkpoint(self, feed: str) -> str:
        return f"{self.base}/checkpoints/{feed}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on whatever file system the path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def stored(
    spark: SparkSession, path: str, schema: StructType, table_format: str = "parquet"
) -> DataFrame | None:
    """A stored table with its fixed schema, or None when there is none at the path."""
    if table_format == "delta":  # Delta keeps the schema itself
        if not exists(spark, f"{path}/_delta_log"):
            return None
        return spark.read.format("delta").load(path)
    if not exists(spark, path):
        return None
    return spark.read.format(table_format).schema(schema).load(path)


def _required(table: DataFrame | None, what: str) -> DataFrame:
    if table is None:
        raise FileNotFoundError(f"no {what} has been written yet")
    return table


def in_partitions(partitions: list, partition_by: Sequence[str]) -> Column:
    """A predicate on partition columns only, which Spark turns into folder pruning.

    The list is as long as the calendar months touched, not as the data, and it is
    one flat membership test, however many there are.
    """
    wanted = ["/".join(str(p[c]) for c in partition_by) for p in partitions]
    return F.concat_ws("/", *partition_by).isin(wanted)


def read_bronze(
    spark: SparkSession, lake: Lake, since: Date | None = None, feed: bool = True, until: Date | None = None
) -> DataFrame:
    """All loads, or those of run dates from ``since`` to ``until`` (partition filters); without ``feed``, batch loads only."""
    found = [
        stored(spark, lake.bronze, BRONZE, lake.table_format),
        stored(spark, lake.bronze_stream, BRONZE) if feed else None,
    ]
    found = [table.select(*BRONZE.names) for table in found if table is not None]
    bronze = _required(reduce(DataFrame.unionByName, found) if found else None, "Bronze table")
    if since is not None:
        bronze = bronze.filter(F.col("pipeline_run_date") >= F.lit(since).cast("date"))
    if until is not None:
        bronze = bronze.filter(F.col("pipeline_run_date") <= F.lit(until).cast("date"))
    return bronze


def read_silver(spark: SparkSession, lake: Lake, start: Date | None = None, end: Date | None = None) -> DataFrame:
    """All transactions, or those of the days from ``start`` to ``end``, both included.

    A date range says which months it can be in; Spark doesn't know that, so it is said here,
    and the folders of other months are not read.
    """
    silver = _required(stored(spark, lake.silver, SILVER, lake.table_format), "Silver table")
    month = F.col("year") * 12 + F.col("month")
    for day, below in ((start, False), (end, True)):
        if day is not None:
            day = F.lit(day).cast("date")
            edge = F.year(day) * 12 + F.month(day)
            silver = silver.filter((month <= edge) & (F.col("date") <= day) if below else (month >= edge) & (F.col("date") >= day))
    return silver


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rejected Bronze rows with their reasons, from batch loads and the streaming feed."""
    schema = StructType([*BRONZE.fields, REASONS_FIELD])
    found = [stored(spark, path, schema) for path in (lake.quarantine, lake.quarantine_stream)]
    found = [table.select(*schema.names) for table in found if table is not None]
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], schema))


LOADED, REFUSED = "loaded", "refused"
LEDGER = (
    StructType()
    .add("path", "string")
    .add("length", "long")
    .add("modified", "long")
    .add("verdict", "string")
    .add("reason", "string")
    .add("loaded_at", "timestamp")
    .add("load", "string")
)
_PROGRESS = StructType().add("run_date", "date").add("finished_at", "timestamp")


def read_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """A line for each file that was loaded or refused, by batch loads and the feed."""
    found = stored(spark, lake.ledger, LEDGER)
    return spark.createDataFrame([], LEDGER) if found is None else found


def read_refused_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """Files that loads left out, with the reason and the time."""
    refused = read_ledger(spark, lake).where(F.col("verdict") == REFUSED)
    return refused.select(F.col("path").alias("file"), "reason", F.col("loaded_at").alias("refused_at"))


def processed_until(spark: SparkSession, lake: Lake) -> datetime.date | None:
    """The last run date that :func:`tillflow.plans.medallion.run` has brought into Silver."""
    found = stored(spark, lake.progress, _PROGRESS)
    return found and found.agg(F.max("run_date")).first()[0]


_VERSIONS = (
    StructType()
    .add("version", "string")
    .add("published_at", "timestamp")
    .add("changes_until", "long")
    .add("week_year", "string")
)


def gold_versions(spark: SparkSession, lake: Lake) -> DataFrame:
    """One short line for each publication, the last one first."""
    found = stored(spark, lake.gold_versions, _VERSIONS)
    found = spark.createDataFrame([], _VERSIONS) if found is None else found
    return found.orderBy(F.desc("published_at"), F.desc("version"))


def latest_gold_version(spark: SparkSession, lake: Lake) -> str | None:
    """The version published last."""
    latest = gold_versions(spark, lake).first()
    return latest["version"] if latest else None


def read_gold(spark: SparkSession, lake: Lake, version: str | None = None) -> dict[str, DataFrame]:
    """The four Gold tables of one and the same publication, the last one unless another is named."""
    version = version or latest_gold_version(spark, lake)
    if version is None:
        raise FileNotFoundError("no Gold tables have been published yet")
    return {
        table: _required(stored(spark, lake.gold(version, table), schema, lake.table_format), table)
        for table, schema in GOLD.items()
    }


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    """A relational copy of a Gold table; filters and columns are pushed into the database."""
    return spark.read.jdbc(url, table, properties=properties)

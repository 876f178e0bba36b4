"""Publishing the Gold tables."""

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.gold_tables import GOLD, STAMP, TABLES
from tillflow.sinks.tables import overwrite
from tillflow.sources.lake import Lake, read_gold


def publish(
    spark: SparkSession, lake: Lake, gold: dict[str, DataFrame], changes_until: int | None = None, week_year: str = "calendar"
) -> str:
    """Write all four tables as a new version, then make it the current one.

    The last step appends one line, so readers switch between complete sets of
    tables and a failed run leaves the previous version in place.  changes_until:
    the last change of Silver that the tables have; without it the next refresh
    builds them anew.
    """
    version = f"{datetime.datetime.now(datetime.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    for name, df in gold.items():
        table = TABLES[name]
        stamped = df.withColumn(STAMP, F.current_timestamp()).select(*GOLD[name].names)
        overwrite(stamped, lake.gold(version, name), table.partitions, table.order, lake.table_format)
    line = spark.range(1).select(
        F.lit(version).alias("version"),
        F.current_timestamp().alias("published_at"),
        F.lit(changes_until).cast("long").alias("changes_until"),
        F.lit(week_year).alias("week_year"),
    )
    line.coalesce(1).write.mode("append").parquet(lake.gold_versions)
    return version


def create_views(spark: SparkSession, lake: Lake, prefix: str = "gold_") -> list[str]:
    """Temporary views on the current version, for ``spark.sql``."""
    names = []
    for table, df in read_gold(spark, lake).items():
        df.createOrReplaceTempView(prefix + table)
        names.append(prefix + table)
    return names

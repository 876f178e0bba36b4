"""Distinct customers of any days and regions without reading Silver again.

Beside Gold, a bitmap and a sketch of its customers are kept for each day and region.  They
follow Silver by the log of changes: only months that a merge has touched are made again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.gold_tables import DAILY_REVENUE
from tillflow.operators.distincts import (
    BITS,
    BLOCK,
    NUMBER,
    SKETCH,
    bitmaps,
    count_of_bitmaps,
    estimate_of_sketches,
    numbered,
    sketches,
)
from tillflow.plans.gold import months_of
from tillflow.schemas import KEY, SILVER, SILVER_PARTITIONS
from tillflow.sinks import changes
from tillflow.sinks.tables import overwrite, overwrite_partitions
from tillflow.sinks.upsert import recover
from tillflow.sources.lake import Date, Lake, in_partitions, read_silver, stored
from tillflow.sources.staging import cleared, remove, staged

FOLLOWER = "distincts"
CUSTOMER = "customer_id"
GRAIN = [*SILVER_PARTITIONS, *DAILY_REVENUE.keys]
_GRAIN = StructType([SILVER[c] for c in GRAIN])
_CUSTOMERS = StructType([SILVER[CUSTOMER]]).add(NUMBER, "long")
_BITMAPS = StructType(_GRAIN.fields).add(BLOCK, "long").add(BITS, "binary")
_SKETCHES = StructType(_GRAIN.fields).add(SKETCH, "binary")


def refresh_distincts(spark: SparkSession, lake: Lake) -> None:
    """Bring bitmaps and sketches up to Silver; the first call makes them of all of it.

    New customers are numbered before anything uses their numbers.  A call that was
    interrupted is simply repeated.  A reader meanwhile may see a month as it was.
    """
    if lake.table_format != "delta":
        recover(spark, lake.silver, SILVER, SILVER_PARTITIONS, KEY)
    until, done = changes.newest(spark, lake.changes), changes.position(spark, lake, FOLLOWER)
    if until == done:
        return
    silver = read_silver(spark, lake)
    months = None
    if done is not None:
        own = changes.changes_after(spark, lake.changes, done, until).where(F.col("gold") == DAILY_REVENUE.name)
        # One row for each calendar month touched.
        months = months_of(own, DAILY_REVENUE, "calendar").collect()
        silver = silver.where(in_partitions(months, SILVER_PARTITIONS))
    with cleared(spark):
        rows = staged(silver.select(*GRAIN, CUSTOMER).distinct(), "customers")
        known = stored(spark, lake.customers, _CUSTOMERS)
        staged(numbered(rows, CUSTOMER, known), "numbers").write.mode("append").parquet(lake.customers)
        numbers = stored(spark, lake.customers, _CUSTOMERS)
        made = {lake.customer_bitmaps: bitmaps(rows, GRAIN, CUSTOMER, numbers), lake.customer_sketches: sketches(rows, GRAIN, CUSTOMER)}
        for path, table in made.items():
            if months is None:
                overwrite(table, path, SILVER_PARTITIONS, DAILY_REVENUE.keys)
                continue
            overwrite_partitions(table, path, SILVER_PARTITIONS, DAILY_REVENUE.keys)
            left = {tuple(r) for r in rows.where(F.col(CUSTOMER).isNotNull()).select(*SILVER_PARTITIONS).distinct().collect()}
            for month in months:
                if tuple(month) not in left:
                    remove(spark, "/".join([path, *(f"{c}={month[c]}" for c in SILVER_PARTITIONS)]))
    changes.advance(spark, lake, FOLLOWER, until)


def _days(df: DataFrame | None, start: Date | None, end: Date | None) -> DataFrame:
    if df is None:
        raise FileNotFoundError("no distinct customers have been stored yet")
    month = F.col("year") * 12 + F.col("month")
    if start:
        first = F.lit(start).cast("date")
        df = df.where((month >= F.year(first) * 12 + F.month(first)) & (F.col("date") >= first))
    if end:
        last = F.lit(end).cast("date")
        df = df.where((month <= F.year(last) * 12 + F.month(last)) & (F.col("date") <= last))
    return df


def unique_customers(
    spark: SparkSession, lake: Lake, by: list[str], start: Date | None = None, end: Date | None = None
) -> DataFrame:
    """Exact distinct customers of days from start to end by any of year, month, date and store_region."""
    maps = _days(stored(spark, lake.customer_bitmaps, _BITMAPS), start, end)
    return count_of_bitmaps(maps, by, "unique_customers")


def estimated_customers(
    spark: SparkSession, lake: Lake, by: list[str], start: Date | None = None, end: Date | None = None
) -> DataFrame:
    """The same as an estimate, from less data; see ``operators.distincts.STANDARD_ERROR``."""
    found = _days(stored(spark, lake.customer_sketches, _SKETCHES), start, end)
    return estimate_of_sketches(found, by, "estimated_customers")

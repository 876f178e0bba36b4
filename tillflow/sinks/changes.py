"""The log of groups that merges into Silver have touched, for whoever follows Silver."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.gold_tables import CATEGORY_TRENDS, TABLES, GoldTable
from tillflow.schemas import SILVER
from tillflow.sources.lake import Lake, stored

# What tells the groups of any Gold table; a week is told by a day of it.
GROUPS = ["date", "store_region", "store_id", "store_name", "product_id", "product_name", "category"]
CHANGE = "change"
CHANGES = StructType([*(SILVER[c] for c in GROUPS)]).add("gold", "string").add(CHANGE, "long")
_POSITION = StructType().add("consumer", "string").add(CHANGE, "long")


def _keys(table: GoldTable) -> list[str]:
    return ["date", "category"] if table is CATEGORY_TRENDS else table.keys


def touched_groups(rows: DataFrame) -> DataFrame:
    """The groups of all Gold tables that Silver rows belong to, once each."""
    groups = [
        F.struct(
            *(F.col(c).alias(c) if c in _keys(table) else F.lit(None).cast(SILVER[c].dataType).alias(c) for c in GROUPS),
            F.lit(name).alias("gold"),
        )
        for name, table in TABLES.items()
    ]
    return rows.select(F.inline(F.array(*groups))).distinct()


def log(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Note the groups of ``rows`` (old and new versions of what a merge replaces) as the next change."""
    number = newest(spark, path) + 1
    touched_groups(rows).write.mode("overwrite").parquet(f"{path}/{CHANGE}={number}")


def newest(spark: SparkSession, path: str) -> int:
    """The number of the last change, 0 if there is none; only a merge adds one."""
    found = stored(spark, path, CHANGES)
    return (found and found.agg(F.max(CHANGE)).first()[0]) or 0


def changes_after(spark: SparkSession, path: str, after: int, until: int) -> DataFrame:
    """Touched groups of the changes after one and up to another (a partition filter)."""
    found = stored(spark, path, CHANGES)
    if found is None:
        return spark.createDataFrame([], CHANGES)
    return found.where((F.col(CHANGE) > after) & (F.col(CHANGE) <= until))


def position(spark: SparkSession, lake: Lake, consumer: str) -> int | None:
    """The last change that a follower of Silver has taken in; none if it never came."""
    found = stored(spark, lake.positions, _POSITION)
    return found and found.where(F.col("consumer") == consumer).agg(F.max(CHANGE)).first()[0]


def advance(spark: SparkSession, lake: Lake, consumer: str, change: int) -> None:
    line = spark.range(1).select(F.lit(consumer).alias("consumer"), F.lit(change).cast("long").alias(CHANGE))
    line.coalesce(1).write.mode("append").parquet(lake.positions)

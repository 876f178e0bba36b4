"""Dense rank over a whole table, without a sort of its rows in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Whole units are ranked inside ranges of 2**20, these inside ranges of 2**42, and so on.
LEVELS = (20, 42, 64)
UNITS = DecimalType(38, 0)


def dense_rank_desc(stored: DataFrame, by: str, name: str = "revenue_rank") -> DataFrame:
    """Dense rank, largest first, from bounded windows; ``stored`` is read twice.

    A dense rank counts the distinct larger values.  Distinct values, taken as whole units
    (cents, for money), are cut into fixed ranges of 2**20 units, these into ranges of 2**42
    and those into ranges of 2**64.  Then rank = position inside the range + distinct values
    in higher ranges of each level.  A window holds at most 2**22 rows per partition whatever
    the data look like; the last one has a row for each 2**64 units, of which every amount
    that a bigint can hold fills one.  A missing value ranks below all others.
    """
    rows = stored.withColumn("_units", _units(stored, by))
    values = rows.select("_units").distinct().withColumn("_range", _range("_units", LEVELS[0]))
    inside = Window.partitionBy("_range").orderBy(F.col("_units").desc_nulls_last())
    positions = values.withColumn("_position", F.row_number().over(inside))
    # The sizes come out of the same windows, without another aggregation.
    counted = positions.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_range")))
    sizes = counted.where("_position = 1").select("_range", "_n")
    rank = (F.col("_position") + F.col("_above")).cast("int")
    ranks = positions.join(_above(sizes, LEVELS[1:]), F.col("_range").eqNullSafe(F.col("_key")))
    ranks = ranks.select(F.col("_units").alias("_ranked"), rank.alias(name))
    return rows.join(ranks, F.col("_units").eqNullSafe(F.col("_ranked"))).drop("_units", "_ranked")


def _range(column: str, bits: int) -> Column:
    """The least number of the range of 2**bits that holds the value; exact on decimals."""
    return (F.col(column) - F.pmod(F.col(column), F.lit(str(1 << bits)).cast(UNITS))).cast(UNITS)


def _above(sizes: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """``_key`` and ``_above`` of each range: how many distinct values the higher ranges hold."""
    if not levels:
        return sizes.select(F.col("_range").alias("_key"), _count_above().alias("_above"))
    wider = sizes.withColumn("_wider", _range("_range", levels[0]))
    near = wider.select("_range", "_wider", _count_above("_wider").alias("_near"))
    far = _above(wider.groupBy(F.col("_wider").alias("_range")).agg(F.sum("_n").alias("_n")), levels[1:])
    joined = near.join(far, F.col("_wider").eqNullSafe(F.col("_key")))
    return joined.select(F.col("_range").alias("_key"), (F.col("_near") + F.col("_above")).alias("_above"))


def _units(df: DataFrame, by: str) -> Column:
    """The value in whole units."""
    kind = df.schema[by].dataType
    if isinstance(kind, DecimalType):
        return (F.col(by) * F.lit(10**kind.scale).cast(DecimalType(kind.scale + 1, 0))).cast(UNITS)
    if kind.typeName() in ("byte", "short", "integer", "long"):
        return F.col(by).cast(UNITS)
    raise TypeError(f"{by} must be a decimal or a whole number to be ranked, not {kind.simpleString()}")


def _count_above(partition: str | None = None) -> Column:
    window = Window.partitionBy(partition) if partition else Window
    window = window.orderBy(F.col("_range").desc_nulls_last())
    return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

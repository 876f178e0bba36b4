"""Distinct counts that can be put together afterwards: exact by bitmaps, estimated by sketches.

Counts of days don't add up to those of months, as a customer may come twice.  Bitmaps over
numbered customers do, by a bitwise or; so do HyperLogLog sketches, which are small whatever
they count but only near the truth.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMBER, BLOCK, BITS, SKETCH = "number", "block", "bits", "sketch"
_PLACE = "place"
SHARES = 1024  # of the values, numbered each by itself
SKETCH_BITS = 12  # 4,096 registers a sketch
# Relative standard error of an estimate; one in 15,000 is further off than four of them.
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def numbered(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """A number from 1 on for each distinct value that ``known`` (value and number) does not have.

    Values are dealt into ``SHARES`` by their hash, and those of share s get s + 1, s + 1 + SHARES
    and so on, so no task sees more than a share and the numbers are nearly dense.
    """
    new = values.where(F.col(column).isNotNull()).select(column).distinct()
    share = F.pmod(F.xxhash64(column), F.lit(SHARES))
    used = F.lit(0)
    if known is not None:
        new = new.join(known.select(column), column, "left_anti")
    new = new.withColumn("share", share)
    if known is not None:
        sizes = known.groupBy(share.alias("share")).agg(F.count(F.lit(1)).alias("used"))
        new, used = new.join(sizes, "share", "left"), F.coalesce("used", F.lit(0))
    place = F.row_number().over(Window.partitionBy("share").orderBy(column)) - 1 + used
    return new.select(column, (place * SHARES + F.col("share") + 1).cast("long").alias(NUMBER))


def bitmaps(rows: DataFrame, grain: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """Which values each group has, as bitmaps of 32,768 numbers; groups without a value have none.

    The numbers are shuffled, at most 32,768 for a bitmap, rather than the bitmaps that every task
    would make of the few numbers it has of each.
    """
    known = rows.select(*grain, column).distinct().join(numbers, column)
    known = known.select(*grain, F.bitmap_bucket_number(NUMBER).alias(BLOCK), F.bitmap_bit_position(NUMBER).alias(_PLACE))
    return known.repartition(*grain, BLOCK).groupBy(*grain, BLOCK).agg(F.bitmap_construct_agg(_PLACE).alias(BITS))


def count_of_bitmaps(maps: DataFrame, grain: Sequence[str], name: str) -> DataFrame:
    """Distinct values of wider groups; maps of one block are put together before they are counted."""
    blocks = maps.groupBy(*grain, BLOCK).agg(F.bitmap_count(F.bitmap_or_agg(BITS)).alias("n"))
    return blocks.groupBy(*grain).agg(F.sum("n").alias(name))


def sketches(rows: DataFrame, grain: Sequence[str], column: str) -> DataFrame:
    """A HyperLogLog sketch of the values of each group."""
    present = rows.where(F.col(column).isNotNull())
    return present.groupBy(*grain).agg(F.hll_sketch_agg(column, SKETCH_BITS).alias(SKETCH))


def estimate_of_sketches(found: DataFrame, grain: Sequence[str], name: str) -> DataFrame:
    """Estimated distinct values of wider groups."""
    return found.groupBy(*grain).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(name))

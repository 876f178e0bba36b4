"""Keep one version of every key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, key: str, recency: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The most recent row per key.

    Rows with the same key and the same recency are ordered by ``tie_break``, by
    default every other column, so the outcome never depends on task order.  The
    ``= 1`` filter lets Spark keep one row per key on the map side already
    (WindowGroupLimit): a key delivered a billion times sends one row per task.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in (key, recency)]
    order = [F.col(c).desc_nulls_last() for c in (recency, *tie_break)]
    newest_first = Window.partitionBy(key).orderBy(*order)
    position = "_version"
    return (
        df.withColumn(position, F.row_number().over(newest_first))
        .filter(F.col(position) == 1)
        .drop(position)
    )

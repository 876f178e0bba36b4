"""Keyed upsert as a DataFrame expression."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillflow.operators.dedupe import latest_per_key


def merged(
    current: DataFrame, incoming: DataFrame, key: str, recency: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Insert new keys and keep the most recent version of known ones.

    An incoming row replaces a stored one only if it is not older, so deliveries
    may be merged in any order.  Of versions of the same time ``tie_break`` decides.
    """
    return latest_per_key(current.unionByName(incoming), key, recency, tie_break)

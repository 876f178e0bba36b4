"""Calendar dimensions of a sale date."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(date: str = "date") -> dict[str, Column]:
    """Calendar year and month, ISO week, and weekday with 1 = Sunday."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "week": F.weekofyear(date),
        "day_of_week": F.dayofweek(date),
        "is_weekend": F.dayofweek(date).isin(1, 7),
    }


def week_year(date: str, kind: str) -> Column:
    """The year a week is filed under.

    ``calendar`` files 2024-12-30 under (2024, week 1); ``iso`` under (2025, week 1).
    """
    if kind == "calendar":
        return F.year(date)
    if kind == "iso":
        return F.extract(F.lit("YEAROFWEEK"), F.col(date)).cast("int")
    raise ValueError(f"week_year must be 'calendar' or 'iso', not {kind!r}")

"""The four Gold aggregates over Silver, from their declarations.

Silver holds one row per transaction, so the number of transactions of a group
is a plain row count and only the remaining distinct counts need a second
aggregation level.  All of them aggregate on the map side first and shuffle the
distinct counts by (group, counted value), so one hot group is spread over tasks.
Revenue leaves as exact decimals; :func:`as_published` turns it into doubles.
"""

from pyspark.sql import DataFrame

from tillflow.functions.calendar import week_year as week_year_of
from tillflow.functions.money import to_double
from tillflow.gold_tables import (
    CATEGORY_TRENDS,
    DAILY_REVENUE,
    PRODUCT_PERFORMANCE,
    STORE_PERFORMANCE,
    GoldTable,
)


def grouped(rows: DataFrame, table: GoldTable, week_year: str = "calendar") -> DataFrame:
    """Rows with the table's grain; ``year`` is the year that a week is filed under."""
    return rows.withColumn("year", week_year_of("date", week_year)) if table is CATEGORY_TRENDS else rows


def totals(silver: DataFrame, table: GoldTable, week_year: str = "calendar") -> DataFrame:
    """One row for each group, not yet ranked."""
    measures = [measure.formula().alias(measure.name) for measure in table.measures]
    return grouped(silver, table, week_year).groupBy(*table.keys).agg(*measures)


def daily_revenue(silver: DataFrame) -> DataFrame:
    """Revenue, volume and customers per day and region."""
    return totals(silver, DAILY_REVENUE)


def product_totals(silver: DataFrame) -> DataFrame:
    """Lifetime figures per product, not yet ranked."""
    return totals(silver, PRODUCT_PERFORMANCE)


def store_totals(silver: DataFrame) -> DataFrame:
    """Lifetime figures per store, not yet ranked."""
    return totals(silver, STORE_PERFORMANCE)


def category_trends(silver: DataFrame, week_year: str = "calendar") -> DataFrame:
    """Weekly revenue and volume per category."""
    return totals(silver, CATEGORY_TRENDS, week_year)


def as_published(gold: DataFrame) -> DataFrame:
    """Decimals as doubles, which is how Gold tables and answers show money."""
    return gold.withColumns(to_double(*[n for n, t in gold.dtypes if t.startswith("decimal")]))

"""Gold tables from Silver, whole or for the groups that merges have touched."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.gold_tables import (
    CATEGORY_TRENDS,
    DAILY_REVENUE,
    PRODUCT_PERFORMANCE,
    STORE_PERFORMANCE,
    TABLES,
    GoldTable,
)
from tillflow.operators.gold import as_published, grouped, totals
from tillflow.operators.rank import dense_rank_desc
from tillflow.schemas import MONEY, SILVER_PARTITIONS
from tillflow.sources.lake import in_partitions
from tillflow.sources.staging import staged


def _finished(rows: DataFrame, table: GoldTable) -> DataFrame:
    if table.ranked_by:
        rows = dense_rank_desc(staged(rows, table.name), table.ranked_by)
    return as_published(rows)


def daily_revenue(silver: DataFrame) -> DataFrame:
    return _finished(totals(silver, DAILY_REVENUE), DAILY_REVENUE)


def product_performance(silver: DataFrame) -> DataFrame:
    return _finished(totals(silver, PRODUCT_PERFORMANCE), PRODUCT_PERFORMANCE)


def store_performance(silver: DataFrame) -> DataFrame:
    return _finished(totals(silver, STORE_PERFORMANCE), STORE_PERFORMANCE)


def category_trends(silver: DataFrame, week_year: str = "calendar") -> DataFrame:
    return _finished(totals(silver, CATEGORY_TRENDS, week_year), CATEGORY_TRENDS)


def all_tables(silver: DataFrame, week_year: str = "calendar") -> dict[str, DataFrame]:
    """All four, from a stored Silver.

    Each reads only its own columns of Silver.  Caching Silver for the four would
    cost more than it saves: it is the largest table and columnar already.
    """
    return {
        "daily_revenue": daily_revenue(silver),
        "product_performance": product_performance(silver),
        "store_performance": store_performance(silver),
        "category_trends": category_trends(silver, week_year),
    }


# --- After a merge ---------------------------------------------------------------


def changed_tables(
    previous: dict[str, DataFrame], silver: DataFrame, changes: DataFrame, week_year: str = "calendar"
) -> dict[str, DataFrame]:
    """All four, with new rows for the groups in ``changes`` and the others as published before.

    changes: rows of ``sinks.changes``, of which a group may have many.  Daily and weekly groups
    are computed from the months they lie in; products and stores from their own rows of all
    months.  Ranks are given anew, from revenues that doubles hold exactly up to 9e13.
    """
    return {
        name: _finished(_renewed(previous[name], silver, changes, table, week_year), table)
        for name, table in TABLES.items()
    }


def _renewed(published: DataFrame, silver: DataFrame, changes: DataFrame, table: GoldTable, week_year: str) -> DataFrame:
    own = changes.where(F.col("gold") == table.name)
    if table is CATEGORY_TRENDS:
        own = grouped(own.withColumn("week", F.weekofyear("date")), table, week_year)
    touched = staged(own.select(*table.keys).distinct(), "touched")
    rows = changed_rows(silver, touched, table, week_year)
    renewed = totals(rows, table, week_year)
    kept = published.join(touched, same(published, touched, table.keys), "left_anti")
    exact = {m.name: F.col(m.name).cast(MONEY) for m in table.measures if m.name == table.ranked_by}
    return kept.select(*renewed.columns).withColumns(exact).unionByName(renewed.withColumns(exact))


def changed_rows(silver: DataFrame, touched: DataFrame, table: GoldTable, week_year: str = "calendar") -> DataFrame:
    """The Silver rows of the touched groups."""
    if table.by_date:
        # One row for each calendar month touched.
        silver = silver.where(in_partitions(months_of(touched, table, week_year).collect(), SILVER_PARTITIONS))
    rows = grouped(silver, table, week_year)
    rows = rows.join(touched, same(rows, touched, table.keys), "left_semi")
    return rows.withColumn("year", F.year("date"))


def months_of(touched: DataFrame, table: GoldTable, week_year: str) -> DataFrame:
    """``year`` and ``month`` of the months that the groups lie in."""
    if table is DAILY_REVENUE:
        return touched.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct()
    # The days of a week lie in two months, or in January and December if it is filed under the calendar year.
    year = F.col("year")
    days = F.sequence(F.make_date(year - 1, F.lit(12), F.lit(1)), F.make_date(year + 1, F.lit(1), F.lit(31)))
    days = touched.select("year").distinct().select(F.explode(days).alias("date")).distinct()
    filed = grouped(days.withColumn("week", F.weekofyear("date")), table, week_year)
    weeks = touched.select("year", "week").distinct()
    days = filed.join(weeks, ["year", "week"], "left_semi")
    return days.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct()


def same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    """Equal in all columns, nulls too."""
    return reduce(Column.__and__, [a[c].eqNullSafe(b[c]) for c in columns])

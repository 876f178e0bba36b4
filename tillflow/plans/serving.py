"""The serving queries, as DataFrames over published Gold tables.

Filters follow one convention: ``None``, an empty text and year 0 mean "all".
Where an order had ties, the id or region of the row settles them, so that pages
and top lists are the same on every run.
"""

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.money import rounded_mean
from tillflow.functions.text import contains_ignoring_case
from tillflow.gold_tables import serving_columns
from tillflow.plans.distincts import unique_customers
from tillflow.schemas import (
    DEFAULT_PAGE_SIZE,
    DEFAULT_TOP,
    MAX_PAGE_SIZE,
    MAX_TOP,
    NO_NAME,
)
from tillflow.sinks.retention import HOURS, register_reader, release_reader
from tillflow.sources.lake import Date, Lake, latest_gold_version, read_gold, read_silver


def _within(name: str, value: int, low: int, high: int | None = None) -> None:
    if not isinstance(value, int) or value < low or (high is not None and value > high):
        limits = f"at least {low}" if high is None else f"from {low} to {high}"
        raise ValueError(f"{name} must be a whole number {limits}, not {value!r}")


def _exact(column: str) -> Column:
    """Published cents as a decimal again, so that sums do not depend on row order."""
    return F.col(column).cast("decimal(18,2)")


def count_of(df: DataFrame) -> DataFrame:
    """One row: how many rows a query has."""
    return df.agg(F.count(F.lit(1)).alias("total"))


# --- KPI summary -------------------------------------------------------------


def _first_name(ordered: DataFrame, column: str) -> Column:
    name = ordered.limit(1).select(column).scalar()
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(NO_NAME))


def region_leaders(daily: DataFrame) -> DataFrame:
    """Regions by revenue over all days, best first."""
    return (
        daily.groupBy("store_region")
        .agg(F.sum(_exact("total_revenue")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "store_region")
    )


def _tops(daily: DataFrame, products: DataFrame, stores: DataFrame) -> dict[str, Column]:
    """The leaders; products and stores need no more than their revenue, id and name."""
    return {
        "top_region": _first_name(region_leaders(daily), "store_region"),
        "top_product": _first_name(products.orderBy(F.desc("total_revenue"), "product_id"), "product_name"),
        "top_store": _first_name(stores.orderBy(F.desc("total_revenue"), "store_id"), "store_name"),
    }


def kpi_summary(daily: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """One row of headline figures from Gold.

    As in the dashboards built on these tables, ``unique_customers`` adds up the
    distinct customers of every (day, region), and ``avg_basket_value`` is the
    plain mean of the group means; :func:`kpi_summary_exact` has the exact ones.
    """
    zero = F.lit(0)
    return daily.agg(
        F.coalesce(F.sum(_exact("total_revenue")), zero).cast("double").alias("total_revenue"),
        F.coalesce(F.sum("transaction_count"), zero).alias("total_transactions"),
        F.coalesce(F.sum("units_sold"), zero).alias("total_units_sold"),
        F.coalesce(F.sum("unique_customers"), zero).alias("unique_customers"),
        F.coalesce(_mean(_exact("avg_basket_value")), zero).cast("double").alias("avg_basket_value"),
    ).withColumns(_tops(daily, products, stores))


def kpi_summary_exact(
    silver: DataFrame, daily: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Headline figures with a true distinct count and a true mean, from Silver."""
    zero = F.lit(0)
    return silver.agg(
        F.coalesce(F.sum("net_revenue"), zero).cast("double").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.coalesce(F.sum("quantity"), zero).alias("total_units_sold"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.coalesce(_mean(F.col("net_revenue")), zero).cast("double").alias("avg_basket_value"),
    ).withColumns(_tops(daily, products, stores))


def _mean(value: Column) -> Column:
    n = F.count(value)
    return F.when(n > 0, rounded_mean(F.sum(value), n))


# --- Daily revenue -----------------------------------------------------------


def daily_revenue(
    daily: DataFrame,
    start_date: Date | None = None,
    end_date: Date | None = None,
    region: str | None = None,
) -> DataFrame:
    """Days from start to end, both included, in regions whose name contains the text."""
    if start_date:
        daily = daily.filter(F.col("date") >= F.lit(start_date).cast("date"))
    if end_date:
        daily = daily.filter(F.col("date") <= F.lit(end_date).cast("date"))
    if region:
        daily = daily.filter(contains_ignoring_case("store_region", region))
    return daily.select(*serving_columns("daily_revenue"))


def daily_revenue_page(
    daily: DataFrame,
    start_date: Date | None = None,
    end_date: Date | None = None,
    region: str | None = None,
    page: int = 1,
    size: int = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """One page of :func:`daily_revenue`, latest day first, with the total on each row."""
    _within("page", page, 1)
    _within("size", size, 1, MAX_PAGE_SIZE)
    matching = daily_revenue(daily, start_date, end_date, region)
    return (
        matching.orderBy(F.desc("date"), "store_region")
        .offset((page - 1) * size)
        .limit(size)
        .withColumns(
            {"total": count_of(matching).scalar(), "page": F.lit(page), "size": F.lit(size)}
        )
    )


def daily_revenue_after(
    daily: DataFrame,
    after: tuple[Date, str | None] | None = None,
    size: int = DEFAULT_PAGE_SIZE,
    start_date: Date | None = None,
    end_date: Date | None = None,
    region: str | None = None,
) -> DataFrame:
    """The rows of :func:`daily_revenue` that follow a token, latest day first.

    The token is the day and region of the last row seen (see :func:`page_token`), None for the
    first page.  It is a predicate that reaches the scan, so a page costs the same however deep
    it lies, where an offset sorts all rows before it.  Regions without a name come first in a day.
    """
    _within("size", size, 1, MAX_PAGE_SIZE)
    matching = daily_revenue(daily, start_date, end_date, region)
    if after is not None:
        day, name = F.lit(after[0]).cast("date"), after[1]
        later = F.col("store_region").isNotNull() if name is None else F.col("store_region") > name
        matching = matching.filter((F.col("date") <= day) & ((F.col("date") < day) | later))
    return matching.orderBy(F.desc("date"), "store_region").limit(size)


def page_token(rows: list[Row]) -> tuple[Date, str | None] | None:
    """What :func:`daily_revenue_after` needs to go on behind a collected page; None if that was empty."""
    return (rows[-1]["date"], rows[-1]["store_region"]) if rows else None


def daily_revenue_envelope(daily: DataFrame, page: int = 1, size: int = DEFAULT_PAGE_SIZE, **filters) -> DataFrame:
    """The page as one row (total, page, size, data); there also beyond the last page."""
    rows = daily_revenue_page(daily, page=page, size=size, **filters)
    position = F.struct(F.date_diff(F.lit("9999-12-31"), "date").alias("_day"), "store_region")
    row = F.struct(position.alias("_at"), F.struct(*serving_columns("daily_revenue")).alias("_row"))
    # At most MAX_PAGE_SIZE rows reach the array.
    data = F.transform(F.array_sort(F.collect_list(row)), lambda r: r["_row"])
    return rows.agg(data.alias("data")).select(
        count_of(daily_revenue(daily, **filters)).scalar().alias("total"),
        F.lit(page).alias("page"),
        F.lit(size).alias("size"),
        "data",
    )


# --- Products, stores, categories ---------------------------------------------


def top_products(
    products: DataFrame, limit: int = DEFAULT_TOP, category: str | None = None
) -> DataFrame:
    """The best products by revenue rank, of one category if given."""
    _within("limit", limit, 1, MAX_TOP)
    if category:
        products = products.filter(contains_ignoring_case("category", category))
    return (
        products.select(*serving_columns("product_performance"))
        .orderBy("revenue_rank", "product_id")
        .limit(limit)
    )


def store_leaderboard(stores: DataFrame, region: str | None = None) -> DataFrame:
    """All stores by revenue rank, of one region if given."""
    if region:
        stores = stores.filter(contains_ignoring_case("store_region", region))
    return stores.select(*serving_columns("store_performance")).orderBy("revenue_rank", "store_id")


def store_detail(stores: DataFrame, store_id: str) -> DataFrame:
    """One store by id in any case; no row if there is none."""
    return stores.filter(F.col("store_id") == store_id.upper()).select(
        *serving_columns("store_performance")
    )


def category_trends(
    trends: DataFrame, year: int | None = None, category: str | None = None
) -> DataFrame:
    """Weekly category figures, latest week first, best category of a week first."""
    if year:
        trends = trends.filter(F.col("year") == year)
    if category:
        trends = trends.filter(contains_ignoring_case("category", category))
    return trends.select(*serving_columns("category_trends")).orderBy(
        F.desc("year"), F.desc("week"), F.desc("weekly_revenue"), "category"
    )


# --- All of them over what is published ------------------------------------------


class Reports:
    """The serving queries bound to the Gold version current at construction.

    That version is kept from ``expire_gold`` until :meth:`close`, the end of a ``with`` block,
    or ``hours`` have passed.
    """

    def __init__(self, spark: SparkSession, lake: Lake, hours: float = HOURS) -> None:
        self._spark, self._lake = spark, lake
        version = latest_gold_version(spark, lake)
        self._reader = register_reader(spark, lake, version, hours) if version else None
        gold = read_gold(spark, lake, version)
        self._daily, self._trends = gold["daily_revenue"], gold["category_trends"]
        self._products, self._stores = gold["product_performance"], gold["store_performance"]

    def __enter__(self) -> "Reports":
        return self

    def __exit__(self, *failure: object) -> None:
        self.close()

    def close(self) -> None:
        """Let the version go."""
        if self._reader:
            release_reader(self._spark, self._lake, self._reader)
            self._reader = None

    def summary(self) -> DataFrame:
        return kpi_summary(self._daily, self._products, self._stores)

    def summary_exact(self) -> DataFrame:
        silver = read_silver(self._spark, self._lake)
        return kpi_summary_exact(silver, self._daily, self._products, self._stores)

    def daily_revenue(self, page: int = 1, size: int = DEFAULT_PAGE_SIZE, **filters) -> DataFrame:
        return daily_revenue_page(self._daily, page=page, size=size, **filters)

    def daily_revenue_after(self, after: tuple[Date, str | None] | None = None, size: int = DEFAULT_PAGE_SIZE, **filters) -> DataFrame:
        return daily_revenue_after(self._daily, after, size, **filters)

    def unique_customers(self, by: list[str], start_date: Date | None = None, end_date: Date | None = None) -> DataFrame:
        """Exact distinct customers of any days, where ``refresh_distincts`` keeps them."""
        return unique_customers(self._spark, self._lake, by, start_date, end_date)

    def daily_revenue_envelope(self, page: int = 1, size: int = DEFAULT_PAGE_SIZE, **filters) -> DataFrame:
        return daily_revenue_envelope(self._daily, page=page, size=size, **filters)

    def top_products(self, limit: int = DEFAULT_TOP, category: str | None = None) -> DataFrame:
        return top_products(self._products, limit, category)

    def store_leaderboard(self, region: str | None = None) -> DataFrame:
        return store_leaderboard(self._stores, region)

    def store_detail(self, store_id: str) -> DataFrame:
        return store_detail(self._stores, store_id)

    def category_trends(self, year: int | None = None, category: str | None = None) -> DataFrame:
        return category_trends(self._trends, year, category)

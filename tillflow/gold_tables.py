"""The four Gold tables: what a row stands for, and every measure once.

Aggregates, stored schemas and the contract of the relational copies follow from these
declarations.  Names, types, widths and orders are fixed values: they have to equal those
of the tables users already own.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tillflow.functions.money import rounded_mean

STAMP = "processed_at"
RANK = "revenue_rank"


@dataclass(frozen=True)
class Measure:
    """A column that sums up the Silver rows of a group."""

    name: str
    type: DataType
    formula: Callable[[], Column]
    adds_up: bool = True  # the value of a whole is the sum of those of its parts


@dataclass(frozen=True)
class GoldTable:
    name: str
    grain: StructType
    measures: tuple[Measure, ...]
    partitions: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    ranked_by: str | None = None
    widths: dict[str, int] = field(default_factory=dict)  # of VARCHAR columns in the relational copy
    unique: str | None = None  # its key there
    by_date: bool = False  # the rows of a group lie in a few months

    @property
    def keys(self) -> list[str]:
        return self.grain.names

    @property
    def schema(self) -> StructType:
        fields = [*self.grain.fields, *(StructField(m.name, m.type) for m in self.measures)]
        if self.ranked_by:
            fields.append(StructField(RANK, IntegerType()))
        return StructType([*fields, StructField(STAMP, TimestampType())])


def _grain(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def _sum(name: str, column: str, kind: DataType) -> Measure:
    return Measure(name, kind, lambda: F.sum(column))


def _distinct(name: str, column: str) -> Measure:
    return Measure(name, LongType(), lambda: F.count_distinct(column), adds_up=False)


def _rows(name: str) -> Measure:
    return Measure(name, LongType(), lambda: F.count(F.lit(1)))


def _mean(name: str, column: str, times: int = 1) -> Measure:
    return Measure(name, DoubleType(), lambda: rounded_mean(F.sum(column) * times, F.count(F.lit(1))), adds_up=False)


DAILY_REVENUE = GoldTable(
    "daily_revenue",
    _grain(date=DateType(), store_region=StringType()),
    (
        _sum("total_revenue", "net_revenue", DoubleType()),
        _sum("gross_revenue", "gross_revenue", DoubleType()),
        _sum("total_discounts", "discount_amount", DoubleType()),
        _sum("units_sold", "quantity", LongType()),
        _rows("transaction_count"),
        _distinct("unique_customers", "customer_id"),
        _mean("avg_basket_value", "net_revenue"),
    ),
    partitions=("store_region",),
    order=("date", "store_region"),
    widths={"store_region": 100},
    by_date=True,
)
PRODUCT_PERFORMANCE = GoldTable(
    "product_performance",
    _grain(product_id=StringType(), product_name=StringType(), category=StringType()),
    (
        _sum("total_revenue", "net_revenue", DoubleType()),
        _sum("total_units_sold", "quantity", LongType()),
        _mean("avg_selling_price", "unit_price"),
        _mean("avg_discount_pct", "discount_pct", times=100),
        _rows("total_transactions"),
        _distinct("stores_selling", "store_id"),
    ),
    order=(RANK, "product_id"),
    ranked_by="total_revenue",
    widths={"product_id": 20, "product_name": 200, "category": 100},
    unique="product_id",
)
STORE_PERFORMANCE = GoldTable(
    "store_performance",
    _grain(store_id=StringType(), store_name=StringType(), store_region=StringType()),
    (
        _sum("total_revenue", "net_revenue", DoubleType()),
        _sum("total_units_sold", "quantity", LongType()),
        _rows("total_transactions"),
        _distinct("unique_customers", "customer_id"),
        _mean("avg_transaction_value", "net_revenue"),
        _distinct("unique_products_sold", "product_id"),
    ),
    order=(RANK, "store_id"),
    ranked_by="total_revenue",
    widths={"store_id": 20, "store_name": 200, "store_region": 100},
    unique="store_id",
)
CATEGORY_TRENDS = GoldTable(
    "category_trends",
    _grain(year=IntegerType(), week=IntegerType(), category=StringType()),
    (
        _sum("weekly_revenue", "net_revenue", DoubleType()),
        _sum("weekly_units_sold", "quantity", LongType()),
        _distinct("distinct_products", "product_id"),
    ),
    partitions=("year",),
    order=("year", "week", "category"),
    widths={"category": 100},
    by_date=True,
)

TABLES = {t.name: t for t in (DAILY_REVENUE, PRODUCT_PERFORMANCE, STORE_PERFORMANCE, CATEGORY_TRENDS)}
GOLD = {name: table.schema for name, table in TABLES.items()}


def serving_columns(table: str) -> list[str]:
    """Columns a serving query returns: everything but the processing stamp."""
    return [name for name in GOLD[table].names if name != STAMP]

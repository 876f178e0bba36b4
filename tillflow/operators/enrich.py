"""From accepted Bronze rows to typed, enriched Silver rows."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.calendar import calendar_columns
from tillflow.functions.money import cents
from tillflow.operators.dedupe import latest_per_key
from tillflow.operators.quality import accepted, parsed_date
from tillflow.schemas import DERIVED, DISCOUNT, KEY, PRICE


def typed(bronze: DataFrame) -> DataFrame:
    """Dates as dates, prices and discounts as decimals, a missing discount as none."""
    return bronze.withColumns(
        {
            "date": parsed_date(bronze),
            "unit_price": F.col("unit_price").try_cast(PRICE),
            "discount_pct": F.coalesce(F.col("discount_pct").try_cast(DISCOUNT), F.lit(0).cast(DISCOUNT)),
        }
    )


def with_revenue(df: DataFrame) -> DataFrame:
    """Gross, discount and net revenue of a line, each rounded to cents."""
    return (
        df.withColumn("gross_revenue", cents(F.col("quantity") * F.col("unit_price")))
        .withColumn("discount_amount", cents(F.col("gross_revenue") * F.col("discount_pct")))
        .withColumn("net_revenue", cents(F.col("gross_revenue") - F.col("discount_amount")))
    )


def enriched(df: DataFrame) -> DataFrame:
    return with_revenue(df).withColumns(calendar_columns())


def derived(df: DataFrame) -> DataFrame:
    """The ``DERIVED`` columns anew."""
    return with_revenue(df).withColumns({name: column for name, column in calendar_columns().items() if name in DERIVED})


def silver_rows(
    bronze: DataFrame, tie_break: Sequence[str] | None = None, strict: Iterable[str] = ()
) -> DataFrame:
    """Bronze -> Silver: filter, type, keep the latest accepted version, enrich.

    Rejected rows leave before the shuffle, so rows without a key never meet in
    one task, and an unusable correction does not hide the last usable version.
    Only surviving versions pay for the conversion to decimals.
    """
    newest = latest_per_key(accepted(bronze, strict), KEY, "ingestion_timestamp", tie_break)
    return enriched(typed(newest))

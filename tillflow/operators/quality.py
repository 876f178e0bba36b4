"""Data-quality rules: which Bronze rows may enter Silver, and why the others may not."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.schemas import CORRUPT, KEY, LEAST_PRICE, MOST_DISCOUNT, MOST_MONEY, REASONS

_DATE = "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"


def parsed_date(df: DataFrame) -> Column:
    """The sale date, or NULL when its text is no date written as yyyy-MM-dd.

    Spark raises and catches an exception for every text a date parser refuses,
    which in a bad delivery costs more than all other work on the row.  The
    pattern keeps nearly all of those away from the cast.
    """
    text = F.col("date")
    if dict(df.dtypes)["date"] == "date":
        return text
    return F.when(text.rlike(_DATE), text.try_cast("date"))


def _requirements(df: DataFrame, strict: Iterable[str]) -> dict[str, Column]:
    """Reason for rejection -> condition a good row meets (NULL counts as not met)."""
    quantity, price, discount = F.col("quantity"), F.col("unit_price"), F.col("discount_pct")
    gross = price * F.coalesce(F.abs(quantity.cast("double")), F.lit(1.0))
    share = F.coalesce(F.abs(discount), F.lit(0.0))
    holds = (price >= LEAST_PRICE) & (gross < MOST_MONEY) & (share < MOST_DISCOUNT) & (gross * share < MOST_MONEY)
    required = {
        "missing_key": F.col(KEY).isNotNull(),
        "bad_quantity": quantity > 0,
        "bad_price": price > 0,
        "bad_date": parsed_date(df).isNotNull(),
        "amount_out_of_range": F.coalesce(price <= 0, F.lit(True)) | holds,
    }
    optional = {"discount_out_of_range": discount.isNull() | discount.between(0, 1)}
    if CORRUPT in df.columns:
        optional["corrupt_record"] = F.col(CORRUPT).isNull()
    unknown = set(strict) - {"discount_out_of_range", "corrupt_record"}
    if unknown:
        raise ValueError(f"unknown optional rules: {sorted(unknown)}")
    return required | {name: rule for name, rule in optional.items() if name in set(strict)}


def accepted(bronze: DataFrame, strict: Iterable[str] = ()) -> DataFrame:
    """Rows that meet every rule.

    Written as one plain filter per rule, so Catalyst merges them and the
    comparisons with constants reach the Parquet scan.
    """
    for condition in _requirements(bronze, strict).values():
        bronze = bronze.filter(condition)
    return bronze


def _broken(bronze: DataFrame, strict: Iterable[str]) -> dict[str, Column]:
    return {name: ~F.coalesce(condition, F.lit(False)) for name, condition in _requirements(bronze, strict).items()}


def is_rejected(bronze: DataFrame, strict: Iterable[str] = ()) -> Column:
    """Whether a row breaks any rule."""
    return reduce(Column.__or__, _broken(bronze, strict).values())


def rejected(bronze: DataFrame, strict: Iterable[str] = ()) -> DataFrame:
    """The complement of :func:`accepted`, with the array of broken rules.

    A malformed CSV line is named as such next to the rule it breaks; on its own
    it is a reason only when ``corrupt_record`` is among the strict rules.
    """
    broken = _broken(bronze, strict)
    any_broken = is_rejected(bronze, strict)
    if CORRUPT in bronze.columns:
        broken["corrupt_record"] = F.col(CORRUPT).isNotNull()
    names = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in broken.items()])
    return bronze.filter(any_broken).withColumn(REASONS, F.split(names, ","))

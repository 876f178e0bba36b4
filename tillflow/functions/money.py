"""Exact money arithmetic on DECIMAL columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.schemas import MONEY


def cents(amount: Column) -> Column:
    """Round half up to two places and keep the result in the money type."""
    return F.round(amount, 2).cast(MONEY)


def rounded_mean(total: Column, n: Column, places: int = 2) -> Column:
    """``total / n`` rounded half up, without any rounding on the way.

    ``round(avg(x), 2)`` rounds twice: ``avg`` of a decimal keeps four places
    more than its input, and a group of some ten thousand rows can have a mean
    that close to half a cent.  A whole-number division gives the digit directly.
    """
    unit = F.lit(10**places)
    half_up = F.call_function("div", F.abs(total) * 2 * unit + n, n * 2)
    return (F.signum(total).cast("int") * half_up).cast("decimal(20,0)") / unit


def to_double(*names: str) -> dict[str, Column]:
    """Argument for ``withColumns`` that hands decimals out as doubles."""
    return {name: F.col(name).cast("double") for name in names}

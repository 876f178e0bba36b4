"""Text predicates of the serving queries."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ignoring_case(column: str, text: str) -> Column:
    """``ILIKE '%text%'``; ``%`` and ``_`` inside the text stay wildcards."""
    return F.ilike(F.col(column), F.lit(f"%{text}%"))

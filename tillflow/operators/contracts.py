"""Checks that a Gold table fits its relational copy: NOT NULL, UNIQUE, VARCHAR, INTEGER."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.gold_tables import GOLD, TABLES, serving_columns
from tillflow.schemas import INTEGER_MAX, INTEGER_MIN

VIOLATIONS = "violations"


def _row_rules(table: str) -> dict[tuple[str, str], Column]:
    """(column, rule) -> condition of a row that breaks it."""
    rules = {(c, "not_null"): F.col(c).isNull() for c in serving_columns(table)}
    for column, width in TABLES[table].widths.items():
        rules[column, f"varchar({width})"] = F.char_length(column) > width
    for field in GOLD[table]:
        if field.dataType.typeName() in ("integer", "long"):
            rules[field.name, "integer"] = ~F.col(field.name).between(INTEGER_MIN, INTEGER_MAX)
    return rules


def violations(table: str, gold: DataFrame) -> DataFrame:
    """One row per rule of the table with the number of rows (or keys) breaking it.

    One pass: where a key must be unique, rows are first counted per key, and the
    other rules ride along in the same aggregation.
    """
    rules = _row_rules(table)
    unique = TABLES[table].unique
    counts = {f"_{i}": condition for i, condition in enumerate(rules.values())}
    if unique is None:
        totals = gold.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    else:
        per_key = gold.groupBy(unique).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count_if(c).alias(n) for n, c in counts.items()]
        )
        repeated = F.col(unique).isNotNull() & (F.col("_rows") > 1)
        totals = per_key.agg(
            F.count_if(repeated).alias("_unique"),
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
        )
        rules = {(unique, "unique"): None} | rules
        counts = {"_unique": None} | counts
    report = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            F.col(count).alias(VIOLATIONS),
        )
        for (column, rule), count in zip(rules, counts)
    ]
    return totals.select(F.inline(F.array(*report)))


def all_violations(gold: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [violations(t, df) for t, df in gold.items()])


class ContractViolation(ValueError):
    """A Gold table does not fit its relational copy."""


def require_contract(table: str, gold: DataFrame) -> None:
    """Raise with the broken rules; the report has one row per rule of a fixed list."""
    broken = violations(table, gold).filter(F.col(VIOLATIONS) > 0).collect()
    if broken:
        raise ContractViolation(
            "; ".join(f"{table}.{r.column_name} {r.rule}: {r.violations}" for r in broken)
        )

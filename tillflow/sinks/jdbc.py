"""Loading Gold tables into their relational copies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.gold_tables import GOLD, TABLES
from tillflow.operators.contracts import require_contract

# Parallel connections a load may open, and rows per round trip.
CONNECTIONS, BATCH_ROWS = 8, 10_000


def column_types(table: str) -> str:
    """Column types for a copy that Spark has to create."""
    names = {"date": "DATE", "string": "STRING", "double": "DOUBLE", "integer": "INT",
             "long": "INT", "timestamp": "TIMESTAMP"}
    widths = TABLES[table].widths
    return ", ".join(
        f"{f.name} VARCHAR({widths[f.name]})" if f.name in widths else f"{f.name} {names[f.dataType.typeName()]}"
        for f in GOLD[table]
    )


def write_options(table: str) -> dict[str, str]:
    """``truncate`` keeps the existing table with its own id, keys and indexes."""
    return {
        "truncate": "true",
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(CONNECTIONS),
        "createTableColumnTypes": column_types(table),
    }


def serving_frame(table: str, gold: DataFrame) -> DataFrame:
    """Columns and types of the relational copy: counts are INTEGER there."""
    longs = [f.name for f in GOLD[table] if f.dataType.typeName() == "long"]
    return gold.select(*GOLD[table].names).withColumns({c: F.col(c).cast("int") for c in longs})


def load(table: str, gold: DataFrame, url: str, properties: dict[str, str]) -> None:
    """Check the contract, then replace the rows of the copy."""
    require_contract(table, gold)
    serving_frame(table, gold).write.options(**write_options(table)).jdbc(
        url, table, mode="overwrite", properties=properties
    )

"""Sale lines read from a star schema (line items, orders, parts, suppliers)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lines_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return lines.join(orders, "l_orderkey", "left")


def sale_facts(spark: SparkSession, folder: str, **replaced: Column) -> DataFrame:
    """One Bronze-shaped row per line item, ids and measures only.

    The ship date plays the load time.  ``(order, line)`` repeats in the data,
    which makes it a natural test for versions of one transaction.
    ``replaced`` gives other expressions for single columns.
    """
    columns = {
        "transaction_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "date": F.col("o_orderdate").cast("date"),
        "store_id": F.concat(F.lit("S"), "l_suppkey"),
        "product_id": F.concat(F.lit("P"), "l_partkey"),
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price": F.col("l_extendedprice"),
        "discount_pct": F.col("l_discount"),
        "customer_id": F.concat(F.lit("C"), "o_custkey"),
        "ingestion_timestamp": F.col("l_shipdate"),
    }
    return _lines_with_orders(spark, folder).select(
        *[column.alias(name) for name, column in (columns | replaced).items()]
    )


def disturbed_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with the faults real deliveries have.

    Returned goods come as negative quantities, untaxed lines without a price,
    orders in progress with an impossible date text, urgent orders with the
    discount in percent instead of a fraction; discounts or customers of some
    priorities are missing, and lines shipped since June 2001 have no key yet.
    """
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    quantity = F.col("l_quantity").cast("int")
    discount = F.col("l_discount")
    return sale_facts(
        spark,
        folder,
        transaction_id=F.when(F.col("l_shipdate") < F.lit("2001-06-01").cast("timestamp_ntz"), key),
        date=F.when(F.col("o_orderstatus") == "P", F.lit("2024-13-99")).otherwise(
            F.col("o_orderdate").cast("date").cast("string")
        ),
        quantity=F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity),
        unit_price=F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")),
        discount_pct=F.when(F.col("o_orderpriority") == "1-URGENT", discount * 100).when(
            F.col("o_orderpriority") != "4-NOT SPECIFIED", discount
        ),
        customer_id=F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("C"), "o_custkey")),
    )


# Store and product attributes depend on the ids, so ids settle every tie.
FACT_TIE_BREAK = ["date", "product_id", "store_id", "quantity", "unit_price", "discount_pct", "customer_id"]


def with_store_attributes(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Attach store name and region.

    One join per table, so that each right side is a plain scan whose size the
    optimizer knows: it broadcasts a table below its threshold and shuffles else.
    """
    suppliers = _table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("s_nationkey").alias("n_nationkey"),
    )
    nations = _table(spark, folder, "nation").select(
        "n_nationkey", F.col("n_regionkey").alias("r_regionkey")
    )
    regions = _table(spark, folder, "region").select(
        "r_regionkey", F.col("r_name").alias("store_region")
    )
    return (
        df.join(suppliers, "store_id", "left")
        .join(nations, "n_nationkey", "left")
        .join(regions, "r_regionkey", "left")
        .drop("n_nationkey", "r_regionkey")
    )


def with_product_attributes(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Attach product name and category."""
    parts = _table(spark, folder, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )
    return df.join(parts, "product_id", "left")


def with_attributes(
    df: DataFrame, spark: SparkSession, folder: str, stores: bool = False, products: bool = False
) -> DataFrame:
    """Attach the attributes a query asks for; the joins it does not need stay away."""
    if stores:
        df = with_store_attributes(df, spark, folder)
    if products:
        df = with_product_attributes(df, spark, folder)
    return df

"""Column names, types and limits shared by every layer; ``gold_tables`` has the Gold tables.

The names, types, orders and numeric limits in this file are fixed values:
they have to equal those of the data files and serving tables users already own.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

KEY = "transaction_id"
CORRUPT = "_corrupt"


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# One line of a landed CSV file, in file order.
RAW = _struct(
    transaction_id=StringType(),
    date=StringType(),
    store_id=StringType(),
    store_name=StringType(),
    store_region=StringType(),
    product_id=StringType(),
    product_name=StringType(),
    category=StringType(),
    quantity=IntegerType(),
    unit_price=DoubleType(),
    discount_pct=DoubleType(),
    customer_id=StringType(),
)

# The reader puts the text of a malformed line here; NULL for a good one.
RAW_WITH_CORRUPT = StructType(RAW.fields + [StructField(CORRUPT, StringType())])

LOAD_METADATA = _struct(
    ingestion_timestamp=TimestampType(),
    source_file=StringType(),
    pipeline_run_date=DateType(),
)
BRONZE = StructType(RAW_WITH_CORRUPT.fields + LOAD_METADATA.fields)
BRONZE_PARTITIONS = ["pipeline_run_date"]

# What the quarantine adds to a rejected Bronze row.
REASONS = "reject_reasons"
REASONS_FIELD = StructField(REASONS, ArrayType(StringType()))

# Prices and discounts keep six places so that sub-cent prices survive the
# move from binary doubles; revenue is money in cents.
PRICE = DecimalType(22, 6)
DISCOUNT = DecimalType(18, 6)
MONEY = DecimalType(18, 2)
# What the types can't hold: a line's gross or discount beyond them (NaN and
# infinity compare as larger), a discount of a trillion, a price that has no six places.
MOST_MONEY, MOST_DISCOUNT, LEAST_PRICE = 9e15, 9e11, 5e-7

SILVER = _struct(
    transaction_id=StringType(),
    date=DateType(),
    store_id=StringType(),
    store_name=StringType(),
    store_region=StringType(),
    product_id=StringType(),
    product_name=StringType(),
    category=StringType(),
    quantity=IntegerType(),
    unit_price=PRICE,
    discount_pct=DISCOUNT,
    customer_id=StringType(),
    gross_revenue=MONEY,
    discount_amount=MONEY,
    net_revenue=MONEY,
    year=IntegerType(),
    month=IntegerType(),
    week=IntegerType(),
    day_of_week=IntegerType(),
    is_weekend=BooleanType(),
    ingestion_timestamp=TimestampType(),
    silver_processed_at=TimestampType(),
)
SILVER_PARTITIONS = ["year", "month"]
# What follows from other columns of a row, and is not carried through shuffles.
DERIVED = ["gross_revenue", "discount_amount", "net_revenue", "week", "day_of_week", "is_weekend"]
# Which version of a transaction wins: the one loaded last, then by content.
RECENCY = "ingestion_timestamp"
TIE_BREAK = [name for name in RAW.names if name != KEY]

INTEGER_MIN, INTEGER_MAX = -2147483648, 2147483647

# Request limits of the serving queries.
DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE = 20, 100
DEFAULT_TOP, MAX_TOP = 10, 50
NO_NAME = "N/A"

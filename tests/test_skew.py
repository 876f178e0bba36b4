"""A third of all rows on one key, with broadcast joins off and small thresholds."""

import glob
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tillflow.settings import configure
from tillflow.operators.dedupe import latest_per_key
from tillflow.operators.enrich import enriched, typed
from tillflow.operators.gold import product_totals
from tillflow.schemas import MONEY, SILVER
from tillflow.sinks.tables import overwrite
from tillflow.sources.staging import staged
from tillflow.sources.star import with_product_attributes


@contextmanager
def settings(spark, **values):
    values = {"spark.sql." + k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """The adaptive plan after the query ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_sales(spark):
    """60,000 lines, a third of them of product P7 and of one month."""
    ids = spark.range(0, 60_000, 1, 8)
    hot = F.col("id") % 3 == 0
    day = F.when(hot, F.lit("2024-05-15").cast("date")).otherwise(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 120).cast("int"))
    )
    lines = ids.select(
        F.concat(F.lit("T"), F.col("id")).alias("transaction_id"),
        day.alias("date"),
        F.concat(F.lit("S"), F.col("id") % 9).alias("store_id"),
        F.concat(F.lit("P"), F.when(hot, F.lit(7)).otherwise(F.col("id") % 200)).alias("product_id"),
        F.lit(1).alias("quantity"),
        (F.col("id") % 1000 + 1).cast("double").alias("unit_price"),
        F.lit(0.1).alias("discount_pct"),
        F.concat(F.lit("C"), F.col("id") % 50).alias("customer_id"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )
    return staged(lines, "hot")


def test_join_splits_a_hot_product(spark, hot_sales):
    silver = enriched(typed(hot_sales))
    plain = product_totals(with_product_attributes(silver, spark, "/root/testdata/sf0.001"))
    expected = {r["product_id"]: tuple(r) for r in plain.collect()}
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20000",
    ):
        configure(spark)
        df = product_totals(with_product_attributes(silver, spark, "/root/testdata/sf0.001"))
        assert "skew=true" in executed(df)
        assert {r["product_id"]: tuple(r) for r in df.collect()} == expected


def test_copies_of_a_hot_key_shrink_before_the_shuffle(spark, hot_sales):
    copies = hot_sales.withColumn(
        "transaction_id", F.when(F.col("product_id") == "P7", F.lit("HOT")).otherwise(F.col("transaction_id"))
    )
    keys = copies.select("transaction_id").distinct().count()
    with settings(spark, adaptive__enabled="false"):
        df = latest_per_key(copies, "transaction_id", "ingestion_timestamp")
        assert len(df.collect()) == keys
        # Rows leaving the map side: every other key once, the hot key once per task.
        tasks = copies.rdd.getNumPartitions()
        assert _shuffled_records(df._jdf.queryExecution().executedPlan()) <= keys - 1 + tasks < 50_000


def _shuffled_records(node):
    """Records written by the exchange of an executed plan."""
    while not node.metrics().contains("shuffleRecordsWritten"):
        node = node.children().apply(0)
    return node.metrics().apply("shuffleRecordsWritten").value()


def test_hot_month_is_written_by_several_tasks(spark, hot_sales, tmp_path):
    silver = enriched(typed(hot_sales))
    with settings(spark, adaptive__advisoryPartitionSizeInBytes="400000"):
        overwrite(silver, str(tmp_path / "silver"), ["year", "month"], ["transaction_id"])
    hot_files = glob.glob(f"{tmp_path}/silver/year=2024/month=5/*.parquet")
    quiet_files = glob.glob(f"{tmp_path}/silver/year=2024/month=2/*.parquet")
    assert len(hot_files) > 1 and len(hot_files) > len(quiet_files)
    back = spark.read.parquet(str(tmp_path / "silver"))
    assert back.count() == 60_000
    assert back.agg(F.sum("net_revenue")).first() == silver.agg(F.sum("net_revenue")).first()
    assert back.schema["net_revenue"].dataType == MONEY == SILVER["net_revenue"].dataType

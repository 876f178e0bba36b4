import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from sales import bronze, line, random_lines, write_csv

from tillflow.operators.contracts import ContractViolation, all_violations, require_contract, violations
from tillflow.plans import medallion
from tillflow.plans.serving import Reports
from tillflow.gold_tables import GOLD
from tillflow.schemas import SILVER_PARTITIONS
from tillflow.sinks import gold as gold_sink
from tillflow.sinks import jdbc
from tillflow.sinks.upsert import upsert
from tillflow.sources.lake import latest_gold_version, read_bronze, read_gold, read_silver


@pytest.fixture
def filled(spark, lake):
    upsert(medallion.to_silver(bronze(spark, random_lines(51, 80))), lake.silver, "transaction_id", SILVER_PARTITIONS)
    return lake


def test_versions_switch_together(spark, filled, monkeypatch):
    first = medallion.refresh_gold(spark, filled)
    gold = read_gold(spark, filled)
    assert {t: {(f.name, f.dataType) for f in df.schema} for t, df in gold.items()} == {
        t: {(f.name, f.dataType) for f in s} for t, s in GOLD.items()
    }
    assert gold["daily_revenue"].filter("processed_at IS NULL").count() == 0

    written, original = [], gold_sink.overwrite

    def fail_on_third(df, path, *rest):
        written.append(path)
        if len(written) == 3:
            raise OSError("disk full")
        original(df, path, *rest)

    monkeypatch.setattr(gold_sink, "overwrite", fail_on_third)
    with pytest.raises(OSError):
        medallion.refresh_gold(spark, filled, full=True)
    monkeypatch.undo()
    assert latest_gold_version(spark, filled) == first, "an incomplete set must not become current"

    second = medallion.refresh_gold(spark, filled, full=True)
    assert latest_gold_version(spark, filled) == second != first
    assert os.listdir(filled.gold(second, "category_trends"))
    folders = {f for f in os.listdir(filled.gold(second, "daily_revenue")) if "=" in f}
    assert folders == {"store_region=North", "store_region=South", "store_region=East_1"}
    assert {f for f in os.listdir(filled.gold(second, "category_trends")) if "=" in f} == {"year=2024", "year=2025"}


def test_views(spark, filled):
    medallion.refresh_gold(spark, filled)
    assert gold_sink.create_views(spark, filled, "g_") == [f"g_{t}" for t in GOLD]
    row = spark.sql("SELECT sum(transaction_count) FROM g_daily_revenue").first()
    assert row[0] == 80


def test_whole_run(spark, lake, tmp_path):
    source = write_csv(tmp_path / "sales.csv", random_lines(52, 60))
    assert medallion.run(spark, lake, source).row_count == 60
    assert medallion.run(spark, lake, source).row_count == 0, "known files are not loaded again"
    reports = Reports(spark, lake)
    assert reports.summary().first()["total_transactions"] == 60
    assert reports.summary_exact().first()["total_transactions"] == 60
    assert reports.daily_revenue(size=3).count() == 3
    assert len(reports.daily_revenue_envelope(size=3, region="n").first()["data"]) == 3
    assert reports.top_products(2).count() == 2
    assert reports.store_detail("s01").count() == 1 and reports.store_leaderboard("north").count() == 2
    assert reports.category_trends(2025, "toys").select("category").distinct().count() == 1


def test_run_since_a_date(spark, lake, tmp_path):
    first = write_csv(tmp_path / "1.csv", [line("A", quantity=1), line("B", quantity=1)])
    second = write_csv(tmp_path / "2.csv", [line("A", quantity=2)])
    medallion.run(spark, lake, first)
    today = read_bronze(spark, lake).first()["pipeline_run_date"]
    medallion.run(spark, lake, second, since=today)
    medallion.refresh_silver(spark, lake, since="2099-01-01")
    got = {r["transaction_id"]: r["quantity"] for r in read_silver(spark, lake).collect()}
    assert got == {"A": 2, "B": 1}


def test_contract_report(spark, filled):
    medallion.refresh_gold(spark, filled)
    gold = read_gold(spark, filled)
    report = all_violations(gold)
    assert report.filter("violations > 0").count() == 0 and report.count() > 40
    products = gold["product_performance"]
    renamed = products.unionByName(products.withColumn("product_name", F.repeat(F.lit("x"), 201)))
    huge = renamed.withColumn("total_units_sold", F.lit(2**31)).withColumn("category", F.lit(None).cast("string"))
    found = {
        (r["column_name"], r["rule"]): r["violations"]
        for r in violations("product_performance", huge).filter("violations > 0").collect()
    }
    n = products.count()
    assert found == {
        ("product_id", "unique"): n,
        ("product_name", "varchar(200)"): n,
        ("category", "not_null"): 2 * n,
        ("total_units_sold", "integer"): 2 * n,
    }
    require_contract("product_performance", products)
    with pytest.raises(ContractViolation, match="total_units_sold integer"):
        jdbc.load("product_performance", huge, "jdbc:none:", {})
    assert violations("store_performance", gold["store_performance"].limit(0)).filter("violations <> 0").count() == 0


def test_relational_copy(spark, filled):
    medallion.refresh_gold(spark, filled)
    for table, df in read_gold(spark, filled).items():
        declared = StructType.fromDDL(jdbc.column_types(table).replace("VARCHAR(", "CHAR("))
        assert declared.names == GOLD[table].names
        frame = jdbc.serving_frame(table, df)
        assert frame.columns == GOLD[table].names and "bigint" not in dict(frame.dtypes).values()
        assert jdbc.write_options(table)["truncate"] == "true"


def test_renamed_store_breaks_the_unique_rule(spark, lake):
    lines = [line("A"), line("B", store_name="Store 1 (moved)")]
    upsert(medallion.to_silver(bronze(spark, lines)), lake.silver, "transaction_id", SILVER_PARTITIONS)
    medallion.refresh_gold(spark, lake)
    with pytest.raises(ContractViolation, match="store_id unique: 1"):
        require_contract("store_performance", read_gold(spark, lake)["store_performance"])

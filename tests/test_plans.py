"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from compare import registered
from pyspark.sql import functions as F
from sales import bronze, random_lines

from tillflow.operators.dedupe import latest_per_key
from tillflow.operators.enrich import silver_rows
from tillflow.operators.gold import daily_revenue, store_totals
from tillflow.operators.rank import dense_rank_desc
from tillflow.plans import medallion, serving
from tillflow.schemas import BRONZE, SILVER_PARTITIONS
from tillflow.sinks.upsert import upsert
from tillflow.sources import staging
from tillflow.sources.lake import in_partitions, read_silver, stored

FOLDER = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture
def stored_bronze(spark, tmp_path):
    path = str(tmp_path / "bronze")
    df = bronze(spark, random_lines(71, 50)).withColumns(
        {"source_file": F.lit("f"), "pipeline_run_date": F.lit("2024-06-01").cast("date")}
    )
    df.write.partitionBy("pipeline_run_date").parquet(path)
    return stored(spark, path, BRONZE)


def test_rules_reach_the_scan_and_copies_are_dropped_before_the_shuffle(stored_bronze):
    text = plan(silver_rows(stored_bronze))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for condition in ("IsNotNull(transaction_id)", "GreaterThan(quantity,0)", "GreaterThan(unit_price,0.0)"):
        assert condition in pushed
    steps = text.split("\n\n")[0]
    assert steps.count("WindowGroupLimit") == 2 and steps.count("Exchange") == 1


def test_daily_revenue_reads_only_its_columns_and_spreads_hot_groups(spark):
    silver = staging.staged(medallion.to_silver(bronze(spark, random_lines(72, 50))), "test")
    text = plan(daily_revenue(silver))
    assert re.search(r"ReadSchema: struct<([^>]*)>", text).group(1).count(":") == 7
    assert "hashpartitioning(date" in text and "customer_id" in re.search(r"hashpartitioning\((date.*)", text).group(1)
    assert "Expand" not in text, "one distinct count needs no expansion"
    assert "Expand" in plan(store_totals(silver)), "two distinct counts share one pass"


def test_distributed_rank_has_one_small_single_task_window(spark):
    df = staging.staged(spark.range(100).select(F.col("id").cast("decimal(28,2)").alias("total")), "test")
    text = plan(dense_rank_desc(df, "total", "r"), "simple")
    single = [part for part in text.split("Exchange") if "SinglePartition" in part.split("\n")[0]]
    assert len(single) == 1 and "_wider" in single[0], "only the sums of the widest ranges meet in one task"


def test_top_list_is_taken_without_a_full_sort(spark):
    df = staging.staged(registered.queries()["gold_product_performance"](spark, FOLDER), "test")
    assert "TakeOrderedAndProject" in plan(serving.top_products(df), "simple")


def test_gold_filters_reach_the_scan(spark):
    df = staging.staged(registered.queries()["gold_category_trends"](spark, FOLDER), "test")
    assert "EqualTo(year,1997)" in plan(serving.category_trends(df, 1997))


def test_upsert_reads_touched_partitions_only(spark, lake):
    silver = medallion.to_silver(bronze(spark, random_lines(73, 80)))
    upsert(silver, lake.silver, "transaction_id", SILVER_PARTITIONS)
    touched = [{"year": 2025, "month": 1}]
    part = read_silver(spark, lake).filter(in_partitions(touched, SILVER_PARTITIONS))
    assert "PartitionFilters: [(concat_ws(/, cast(year" in plan(part)
    assert {f.rsplit("/", 2)[1] for f in part.inputFiles()} >= {"month=1"}
    assert part.select("year", "month").distinct().collect() == [(2025, 1)]


def test_run_dates_prune_bronze_partitions(stored_bronze):
    text = plan(stored_bronze.filter(F.col("pipeline_run_date") >= F.lit("2024-06-01").cast("date")))
    assert "PartitionFilters: [isnotnull(pipeline_run_date" in text


def test_versions_are_compared_without_python(stored_bronze):
    assert "Python" not in plan(latest_per_key(stored_bronze, "transaction_id", "ingestion_timestamp"))


def test_shared_folder_comes_from_the_session(spark, shared_folder):
    assert staging.shared_folder(spark) == shared_folder
    assert staging.staged(spark.range(3), "x").inputFiles()[0].startswith(
        f"file://{shared_folder}/{spark.sparkContext.applicationId}/x-"
    )


class _Session:
    """A session without a shared folder."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_without_a_setting_only_a_local_session_makes_its_own_folder():
    local = _Session("local[2]")
    assert staging.shared_folder(local) == staging.shared_folder(local) == local.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(_Session("yarn"))

"""Gold versions, readers and leftovers that go, and those that stay; merges that know where keys live."""

import datetime
import os
import random
import re

import pytest
from sales import LOADED, bronze, line, random_lines
from test_plans import plan
from test_upsert import content, expected, put

from tillflow.operators.contracts import violations
from tillflow.plans import medallion, serving
from tillflow.plans.serving import Reports
from tillflow.schemas import SILVER, SILVER_PARTITIONS
from tillflow.sinks import directory, retention
from tillflow.sinks.upsert import merge_statement, upsert
from tillflow.sources import staging
from tillflow.sources.lake import read_silver, stored


@pytest.fixture
def filled(spark, lake):
    medallion.merge_into_silver(spark, lake, medallion.to_silver(bronze(spark, random_lines(51, 80))))
    return lake


def test_open_reports_keep_their_version(spark, filled):
    versions = [medallion.refresh_gold(spark, filled, full=True)]
    reports = Reports(spark, filled)
    versions += [medallion.refresh_gold(spark, filled, full=True) for _ in range(3)]
    os.makedirs(filled.gold("20200101T000000-failed", "daily_revenue"))
    assert retention.expire_gold(spark, filled) == [], "all are too young"
    assert retention.expire_gold(spark, filled, keep=1, hours=0) == ["20200101T000000-failed", *versions[1:3]]
    assert reports.summary().first()["total_transactions"] == 80
    with reports:
        pass
    short = Reports(spark, filled, hours=0)
    assert retention.expire_gold(spark, filled, keep=1, hours=0) == versions[:1]
    assert short.summary().first()["total_transactions"] == 80, "the last version always stays"
    assert not [f for f in os.listdir(filled.gold_readers) if f.startswith("reader=")], "readers whose time is over are gone"


def test_staged_folders_of_other_applications_go_by_age(spark, shared_folder):
    own = staging.staged(spark.range(3), "own")
    for name in ("local-1", "application_1_2", "somebody-else"):
        os.makedirs(f"{shared_folder}/{name}")
    assert retention.expire_staged(spark) == []
    for name in ("local-1", "application_1_2", "somebody-else", spark.sparkContext.applicationId):
        os.utime(f"{shared_folder}/{name}", (1, 1))
    assert retention.expire_staged(spark) == ["application_1_2", "local-1"]
    assert own.count() == 3 and os.path.isdir(f"{shared_folder}/somebody-else")


def test_pages_by_token_are_the_whole(spark, filled):
    with Reports(spark, filled) if medallion.refresh_gold(spark, filled) else None as reports:
        whole = [tuple(r)[:2] for r in reports.daily_revenue(size=100).collect()]
        pages, token = [], None
        while rows := reports.daily_revenue_after(token, size=7).collect():
            pages += [tuple(r)[:2] for r in rows]
            token = serving.page_token(rows)
        assert pages == whole and len(whole) > 21 and serving.page_token([]) is None
        steps = plan(reports.daily_revenue_after(("2025-01-10", "North"), region="t"), "formatted")
        assert "TakeOrderedAndProject" in steps and "LessThanOrEqual(date,2025-01-10)" in steps
    nameless = spark.createDataFrame([("2024-01-02", None), ("2024-01-02", "a"), ("2024-01-01", None)], "date string, store_region string")
    nameless = nameless.selectExpr("cast(date as date) as date", "store_region", *(f"0 as {c}" for c in serving.serving_columns("daily_revenue")[2:]))
    assert [tuple(r)[1] for r in serving.daily_revenue_after(nameless, ("2024-01-02", None)).collect()] == ["a", None]


def test_date_ranges_prune_months(spark, filled):
    some = read_silver(spark, filled, "2024-12-28", "2025-01-07")
    days = {str(r["date"]) for r in some.select("date").distinct().collect()}
    every = {r["date"] for r in random_lines(51, 80)}
    assert days == {d for d in every if "2024-12-28" <= d <= "2025-01-07"}
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan(some)) and "GreaterThanOrEqual(date,2024-12-28)" in plan(some)
    assert read_silver(spark, filled, end="2024-12-31").count() + read_silver(spark, filled, "2025-01-01").count() == 80


def test_region_text_prunes_folders(spark, filled):
    medallion.refresh_gold(spark, filled)
    found = serving.daily_revenue(medallion.read_gold(spark, filled)["daily_revenue"], region="NORT")
    assert re.search(r"PartitionFilters: \[[^\n]*ilike|PartitionFilters: \[[^\n]*lower\(store_region", plan(found))


def test_merges_read_the_folders_of_their_keys(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, path, random_lines(31, 200))
    put(spark, path, random_lines(31, 3))
    keys, buckets = directory.opened(stored(spark, path, SILVER), path, "transaction_id", SILVER_PARTITIONS)
    assert buckets == directory.LEAST_BUCKETS and keys.count() == 200
    incoming = staging.staged(medallion.to_silver(bronze(spark, [line("T00007"), line("NEW")])), "incoming")
    living = directory.residence(keys, buckets, incoming, "transaction_id")
    assert re.search(r"PartitionFilters: \[[^\]]*bucket__[^\]]* (IN|INSET) ", plan(living)) and living.count() == 1
    assert plan(living).count("silver__keys") and not re.search(r"silver/year", plan(living))


def test_random_merges_with_and_without_a_directory(spark, tmp_path, monkeypatch):
    rng, path, model = random.Random(9), str(tmp_path / "silver"), {}
    monkeypatch.setattr(directory, "BUCKET_ROWS", 1)  # outgrown all the time
    monkeypatch.setattr(directory, "MOST_BUCKETS", 32)
    for step in range(5):
        batch = [line(f"T{k}", day=f"2024-{rng.randint(1, 6):02}-11", quantity=rng.randint(1, 9)) for k in rng.sample(range(80), 30)]
        put(spark, path, batch)
        model |= {r["transaction_id"]: r for r in batch}
        assert content(spark, path) == expected(model.values())
        if step == 2:
            directory.forget(spark, path)
    late = [line("T1", day="2023-01-01", quantity=99), line("T2", day="2023-01-01")]
    before = content(spark, path)
    put(spark, path, late, LOADED - datetime.timedelta(days=1))
    assert {k: v for k, v in content(spark, path).items() if k in before} == before, "an older version moves no key"
    keys, _ = directory.opened(stored(spark, path, SILVER), path, "transaction_id", SILVER_PARTITIONS)
    assert {r[0]: (r[1], r[2]) for r in keys.select("transaction_id", "year", "month").collect()} == {
        k: v[2:] for k, v in content(spark, path).items()
    }


def test_merge_statement_has_the_order_of_versions_and_the_months(spark):
    text = merge_statement("/s", "v", "id", ["year", "month"], ["loaded", "quantity"], [{"year": 2024, "month": 3}])
    assert "struct(fresh.`loaded`, fresh.`quantity`) >= struct(kept.`loaded`, kept.`quantity`)" in text
    assert "ON kept.`id` = fresh.`id` AND concat_ws('/', kept.`year`, kept.`month`) IN ('2024/3')" in text
    assert "MergeIntoTable" in spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert spark.sql("SELECT struct(1, cast(null as int)) >= struct(1, 2)").first()[0] is False, "nulls are least, as in Silver"


def test_delta_and_parquet_agree_on_ties(spark, tmp_path):
    path = str(tmp_path / "silver")
    for quantity in (3, 9, 5):
        upsert(medallion.to_silver(bronze(spark, [line("A", quantity=quantity)], LOADED)), path, "transaction_id", SILVER_PARTITIONS)
    assert content(spark, path)["A"][1] == 9


def test_least_integer_fits_the_contract(spark, filled):
    medallion.refresh_gold(spark, filled)
    stores = medallion.read_gold(spark, filled)["store_performance"]
    low = stores.selectExpr("* except (total_units_sold, revenue_rank)", "-2147483648L as total_units_sold", "cast(-2147483648 as int) as revenue_rank")
    assert violations("store_performance", low).where("violations > 0").count() == 0
    lower = low.selectExpr("* except (total_units_sold)", "-2147483649L as total_units_sold")
    assert violations("store_performance", lower).where("violations > 0").first()["column_name"] == "total_units_sold"

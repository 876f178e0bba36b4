"""Gold and distinct customers that follow the changes of Silver."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F
from sales import bronze, line
from test_plans import plan

from tillflow.gold_tables import CATEGORY_TRENDS, DAILY_REVENUE, TABLES
from tillflow.operators.distincts import STANDARD_ERROR, numbered
from tillflow.plans import distincts, gold, medallion
from tillflow.plans.gold import changed_rows, months_of
from tillflow.sinks import changes
from tillflow.sources.lake import latest_gold_version, read_gold, read_silver
from tillflow.sources.staging import staged


def deliver(spark, lake, lines, minute):
    medallion.merge_into_silver(spark, lake, medallion.to_silver(bronze(spark, [r | {"loaded": minute} for r in lines])))


def tables(spark, lake, rebuilt, week_year="calendar"):
    """Published tables, or the same built from the whole of Silver."""
    found = gold.all_tables(read_silver(spark, lake), week_year) if rebuilt else read_gold(spark, lake)
    return {n: sorted((tuple(r) for r in df.select(*TABLES[n].schema.names[:-1]).collect()), key=str) for n, df in found.items()}


@pytest.fixture
def minutes():
    from sales import LOADED, datetime

    return (LOADED + datetime.timedelta(minutes=m) for m in range(1000))


@pytest.mark.parametrize("week_year", ["calendar", "iso"])
def test_random_deliveries_leave_the_same_as_a_rebuild(spark, lake, minutes, week_year):
    rng = random.Random(4)
    days = ["2023-01-01", "2023-12-31", "2024-01-01", "2024-03-05", "2024-12-29", "2024-12-30", "2025-01-02"]
    for step in range(3):
        batch = [
            line(f"T{k}", day=rng.choice(days if step != 2 else days[:1]), store=rng.randrange(4), product=rng.randrange(6), quantity=rng.randint(1, 9),
                 customer=rng.choice([None, "C1", "C2", "C3"]), store_region=rng.choice(["North", "South", None]))
            for k in rng.sample(range(60), 30 if step != 2 else 3)
        ]
        deliver(spark, lake, batch, next(minutes))
        version = medallion.refresh_gold(spark, lake, week_year)
        assert tables(spark, lake, False) == tables(spark, lake, True, week_year)
        assert medallion.refresh_gold(spark, lake, week_year) == version == latest_gold_version(spark, lake), "nothing new"
    other = {"calendar": "iso", "iso": "calendar"}[week_year]
    medallion.refresh_gold(spark, lake, other)
    assert tables(spark, lake, False) == tables(spark, lake, True, other)


def test_only_touched_groups_are_computed(spark, lake, minutes, monkeypatch):
    deliver(spark, lake, [line(f"T{m}", day=f"2024-{m:02}-03", store=m % 3, product=m) for m in range(1, 13)], next(minutes))
    medallion.refresh_gold(spark, lake)
    deliver(spark, lake, [line("T5", day="2024-07-03", store=5 % 3, product=9)], next(minutes))
    touched = changes.changes_after(spark, lake.changes, 0, changes.newest(spark, lake.changes)).collect()
    daily = {(str(r["date"]), r["store_region"]) for r in touched if r["gold"] == "daily_revenue"}
    assert daily == {("2024-05-03", "East_1"), ("2024-07-03", "East_1")}
    assert {r["product_id"] for r in touched if r["gold"] == "product_performance"} == {"P005", "P009"}
    silver = read_silver(spark, lake)
    frame = staged(spark.createDataFrame(touched, changes.CHANGES), "touched")
    own = frame.where(F.col("gold") == "daily_revenue").select(*DAILY_REVENUE.keys).distinct()
    rows = changed_rows(silver, own, DAILY_REVENUE)
    assert "PartitionFilters: [concat_ws(/" in plan(rows, "formatted").replace("(concat_ws", "concat_ws")
    monkeypatch.setattr(medallion, "all_tables", None)
    medallion.refresh_gold(spark, lake)
    assert tables(spark, lake, False) == tables(spark, lake, True)


def test_months_of_weeks(spark):
    weeks = spark.createDataFrame([(2024, 1, "x"), (2025, 1, "x"), (2024, 14, None)], CATEGORY_TRENDS.grain)
    calendar = {tuple(r) for r in months_of(weeks, CATEGORY_TRENDS, "calendar").collect()}
    # 2024-12-30 is in ISO week 1 and filed under 2024 by the calendar year.
    assert calendar == {(2024, 1), (2024, 12), (2025, 1), (2025, 12), (2024, 4)}
    iso = {tuple(r) for r in months_of(weeks, CATEGORY_TRENDS, "iso").collect()}
    assert iso == {(2024, 1), (2024, 12), (2025, 1), (2024, 4)}


def test_interrupted_merge_is_finished_before_gold_follows(spark, lake, minutes, monkeypatch):
    from tillflow.sinks import upsert as upsert_module

    deliver(spark, lake, [line("A", day="2024-01-31"), line("B", day="2024-02-01")], next(minutes))
    medallion.refresh_gold(spark, lake)

    def fail(*args):
        raise OSError("driver lost")

    monkeypatch.setattr(upsert_module, "overwrite_partitions", fail)
    with pytest.raises(OSError):
        deliver(spark, lake, [line("A", day="2024-02-02", quantity=7)], next(minutes))
    monkeypatch.undo()
    medallion.refresh_gold(spark, lake)
    assert tables(spark, lake, False) == tables(spark, lake, True)
    assert {str(r["date"]) for r in read_gold(spark, lake)["daily_revenue"].collect()} == {"2024-02-01", "2024-02-02"}


def test_distinct_customers_of_any_range(spark, lake, minutes):
    rng, model = random.Random(3), {}
    for step in range(3):
        batch = [
            line(f"T{k}", day=f"2024-{rng.randint(1, 4) if step < 2 else 2:02}-{rng.randint(1, 28):02}", store=rng.randrange(4), customer=rng.choice([None, *(f"C{c}" for c in range(40))]))
            for k in rng.sample(range(200), 120 if step < 2 else 9)
        ]
        model |= {r["transaction_id"]: r for r in batch}
        deliver(spark, lake, batch, next(minutes))
        for _ in range(2):
            distincts.refresh_distincts(spark, lake)

        def exact(of, start="2024-01-01", end="2024-12-31"):
            found = {}
            for r in model.values():
                if start <= r["date"] <= end and r["customer_id"]:
                    found.setdefault(of(r), set()).add(r["customer_id"])
            return {k: len(v) for k, v in found.items()}

        by_month = {r["month"]: r["unique_customers"] for r in distincts.unique_customers(spark, lake, ["year", "month"]).collect()}
        assert by_month == exact(lambda r: int(r["date"][5:7]))
        some = distincts.unique_customers(spark, lake, ["store_region"], "2024-01-20", "2024-03-05")
        assert dict(some.collect()) == exact(lambda r: r["store_region"], "2024-01-20", "2024-03-05")
        assert re.search(r"PartitionFilters: \[[^\]]*year", plan(some))
        guess = dict(distincts.estimated_customers(spark, lake, ["store_region"]).collect())
        truth = exact(lambda r: r["store_region"])
        assert guess.keys() == truth.keys() and all(abs(guess[k] - n) <= 4 * STANDARD_ERROR * n for k, n in truth.items())
    assert distincts.unique_customers(spark, lake, []).first()[0] == exact(lambda r: None)[None]


def test_month_that_lost_its_customers(spark, lake, minutes):
    deliver(spark, lake, [line("A", day="2024-01-31"), line("B", day="2024-02-01", customer="C2")], next(minutes))
    distincts.refresh_distincts(spark, lake)
    deliver(spark, lake, [line("A", day="2024-02-02", customer=None)], next(minutes))
    distincts.refresh_distincts(spark, lake)
    assert [tuple(r) for r in distincts.unique_customers(spark, lake, ["month"]).collect()] == [(2, 1)]
    assert not os.path.exists(f"{lake.customer_bitmaps}/year=2024/month=1")


def test_numbers_stay_and_are_nearly_dense(spark):
    first = staged(numbered(spark.range(3000).select(F.concat(F.lit("c"), "id").alias("c")), "c"), "numbers")
    more = spark.range(2000, 5000).select(F.concat(F.lit("c"), "id").alias("c")).union(spark.createDataFrame([(None,)], "c string"))
    second = numbered(more, "c", first).collect()
    numbers = [r["number"] for r in first.collect()] + [r["number"] for r in second]
    assert len(second) == 2000 and len(set(numbers)) == 5000 and min(numbers) >= 1 and max(numbers) < 25_000

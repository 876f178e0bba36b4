import datetime

import pytest
from sales import bronze, line, random_lines

from tillflow.operators.enrich import silver_rows
from tillflow.plans import gold, serving
from tillflow.gold_tables import GOLD
from tillflow.sources.staging import staged


@pytest.fixture(scope="module")
def lines():
    return random_lines(41, 500)


@pytest.fixture(scope="module")
def silver(spark, lines):
    return silver_rows(bronze(spark, lines)).cache()


@pytest.fixture(scope="module")
def tables(silver):
    return {name: staged(df, name) for name, df in gold.all_tables(silver).items()}


@pytest.fixture(scope="module")
def empty(spark):
    return {name: spark.createDataFrame([], schema) for name, schema in GOLD.items()}


def three(tables):
    return [tables[t] for t in ("daily_revenue", "product_performance", "store_performance")]


def test_summary_of_nothing(spark, silver, empty):
    nothing = (0.0, 0, 0, 0, 0.0, "N/A", "N/A", "N/A")
    assert tuple(serving.kpi_summary(*three(empty)).first()) == nothing
    assert tuple(serving.kpi_summary_exact(silver.limit(0), *three(empty)).first()) == nothing


def test_summary(silver, lines, tables):
    daily = tables["daily_revenue"].collect()
    got = serving.kpi_summary(*three(tables)).first()
    exact = serving.kpi_summary_exact(silver, *three(tables)).first()
    assert got["total_revenue"] == exact["total_revenue"] == pytest.approx(sum(r["total_revenue"] for r in daily))
    assert got["total_transactions"] == exact["total_transactions"] == len(lines)
    assert got["unique_customers"] == sum(r["unique_customers"] for r in daily) > exact["unique_customers"] == 4
    assert got["avg_basket_value"] == pytest.approx(sum(r["avg_basket_value"] for r in daily) / len(daily), abs=0.01)
    assert exact["avg_basket_value"] == pytest.approx(exact["total_revenue"] / len(lines), abs=0.01)
    best = tables["product_performance"].filter("revenue_rank = 1").first()
    assert got["top_product"] == exact["top_product"] == best["product_name"]


def test_unnamed_leader_is_shown_as_not_available(spark, tables):
    daily, products, stores = three(tables)
    unnamed = products.withColumn("product_name", serving.F.lit(""))
    assert serving.kpi_summary(daily, unnamed, stores).first()["top_product"] == "N/A"


def test_pages_concatenate_to_the_whole(tables):
    daily = tables["daily_revenue"]
    whole = sorted(
        (tuple(r) for r in serving.daily_revenue(daily, region="o").collect()),
        key=lambda r: (-r[0].toordinal(), r[1]),
    )
    paged, page = [], 1
    while rows := serving.daily_revenue_page(daily, region="o", page=page, size=30).collect():
        assert {(r["total"], r["page"], r["size"]) for r in rows} == {(len(whole), page, 30)}
        paged += [tuple(r)[:9] for r in rows]
        page += 1
    assert paged == whole and len(whole) > 60


def test_envelope_within_and_beyond_the_pages(tables):
    daily = tables["daily_revenue"]
    rows = serving.daily_revenue_page(daily, page=2, size=7).collect()
    one = serving.daily_revenue_envelope(daily, page=2, size=7).first()
    assert [tuple(r) for r in one["data"]] == [tuple(r)[:9] for r in rows]
    beyond = serving.daily_revenue_envelope(daily, page=999, size=7).first()
    assert (beyond["total"], beyond["page"], beyond["size"], beyond["data"]) == (daily.count(), 999, 7, [])


def test_date_range_is_inclusive_and_optional(tables):
    daily = tables["daily_revenue"]
    day = datetime.date(2025, 1, 3)
    assert {r["date"] for r in serving.daily_revenue(daily, day, "2025-01-03").collect()} == {day}
    assert serving.daily_revenue(daily, None, "", "").count() == daily.count()


def test_region_text(tables):
    def regions(text):
        return {r["store_region"] for r in serving.store_leaderboard(tables["store_performance"], text).collect()}

    assert regions("ORTH") == {"North"} and regions("east_1") == {"East_1"}
    assert regions("o_th") == {"North"} or regions("o_th") == {"North", "South"}
    assert regions("%") == regions("") == regions(None) == {"North", "South", "East_1"}
    assert regions("nowhere") == set()


def test_top_products(tables):
    products = tables["product_performance"]
    top = serving.top_products(products, 5).collect()
    assert [r["revenue_rank"] for r in top] == [1, 2, 3, 4, 5] and "processed_at" not in top[0]
    toys = serving.top_products(products, 2, "toy").collect()
    assert len(toys) == 2 and {r["category"] for r in toys} == {"Toys"}, "the filter comes before the limit"


def test_ties_are_settled_by_id(spark):
    lines = [line(f"T{p}", product=p, price=50.0) for p in (3, 1, 2)] + [line("X", product=9, price=1.0)]
    products = gold.product_performance(silver_rows(bronze(spark, lines)))
    got = [(r["product_id"], r["revenue_rank"]) for r in serving.top_products(products).collect()]
    assert got == [("P001", 1), ("P002", 1), ("P003", 1), ("P009", 2)]


def test_store_detail(tables):
    assert serving.store_detail(tables["store_performance"], "s02").first()["store_id"] == "S02"
    assert serving.store_detail(tables["store_performance"], "S99").count() == 0


def test_category_trends(tables):
    rows = serving.category_trends(tables["category_trends"], 2025, "en").collect()
    assert {r["year"] for r in rows} == {2025} and {r["category"] for r in rows} == {"Garden", "Kitchen"}
    order = [(-r["year"], -r["week"], -r["weekly_revenue"]) for r in rows]
    assert order == sorted(order)
    assert serving.category_trends(tables["category_trends"], 0).count() == tables["category_trends"].count()


@pytest.mark.parametrize("wrong", [{"page": 0}, {"size": 0}, {"size": 101}, {"page": 1.5}])
def test_page_limits(tables, wrong):
    with pytest.raises(ValueError):
        serving.daily_revenue_page(tables["daily_revenue"], **wrong)


@pytest.mark.parametrize("limit", [0, 51])
def test_top_limits(tables, limit):
    with pytest.raises(ValueError):
        serving.top_products(tables["product_performance"], limit)

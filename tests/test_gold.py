import random
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from sales import (
    bronze,
    by_key,
    expected_daily,
    expected_products,
    expected_stores,
    expected_trends,
    line,
    random_lines,
)

from tillflow.functions.money import rounded_mean
from tillflow.operators.enrich import silver_rows
from tillflow.operators.rank import dense_rank_desc
from tillflow.plans import gold
from tillflow.gold_tables import GOLD


@pytest.fixture(scope="module")
def lines():
    return random_lines(21, 900) + [line("NEG", discount=1.5, price=999.99), line("NEW", product=1, product_name="Product 1 v2")]


@pytest.fixture(scope="module")
def silver(spark, lines):
    return silver_rows(bronze(spark, lines)).cache()


def test_daily_revenue(silver, lines):
    assert by_key(gold.daily_revenue(silver), 2) == expected_daily(lines)


def test_product_performance(silver, lines):
    assert by_key(gold.product_performance(silver), 3) == expected_products(lines)
    assert by_key(gold.product_performance(silver), 3) == expected_products(lines)


def test_store_performance(silver, lines):
    assert by_key(gold.store_performance(silver), 3) == expected_stores(lines)


def test_category_trends_by_calendar_and_iso_year(silver, lines):
    assert by_key(gold.category_trends(silver), 3) == expected_trends(lines)
    assert by_key(gold.category_trends(silver, "iso"), 3) == expected_trends(lines, iso=True)
    assert expected_trends(lines) != expected_trends(lines, iso=True)
    with pytest.raises(ValueError):
        gold.category_trends(silver, "fiscal")


def test_schemas_and_matching_totals(silver):
    tables = gold.all_tables(silver)
    totals = set()
    for name, df in tables.items():
        expected = [(f.name, f.dataType) for f in GOLD[name] if f.name != "processed_at"]
        assert [(f.name, f.dataType) for f in df.schema] == expected
        revenue = "weekly_revenue" if name == "category_trends" else "total_revenue"
        totals.add(df.agg(F.sum(F.col(revenue).cast("decimal(18,2)"))).first()[0])
    assert totals == {silver.agg(F.sum("net_revenue")).first()[0]}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(10**17), 10**17), st.integers(1, 10**12)), min_size=20, max_size=60))
def test_rounded_mean_is_exact(spark, pairs):
    pairs += [(1, 2), (-1, 2), (3, 2), (5, 1000), (0, 7), (44647, 2), (10**12 - 1, 2 * 10**12)]
    df = spark.createDataFrame([(Decimal(c).scaleb(-2), n) for c, n in pairs], "total decimal(28,2), n bigint")
    got = [r[0] for r in df.select(rounded_mean(F.col("total"), F.col("n"))).collect()]
    for (cents, n), value in zip(pairs, got):
        exact = abs(Fraction(cents, n))
        whole = int(exact + Fraction(1, 2)) * (1 if cents >= 0 else -1)
        assert value * 100 == whole


def test_ranks_agree_on_ties_gaps_and_extremes(spark):
    rng = random.Random(9)
    units = [rng.choice([0, 1, -5, 2**20, 2**20 - 1, -(2**20), 2**41, 2**41 + 7, -(2**45), 10**17, 10**25, 10**25 + 1, -(10**24)]) for _ in range(300)]
    units += [rng.randint(-(2**44), 2**44) for _ in range(300)] + [77] * 400 + [None] * 5
    rows = [(i, None if u is None else Decimal(u).scaleb(-2)) for i, u in enumerate(units)]
    df = spark.createDataFrame(rows, "id int, total decimal(28,2)").cache()
    plain = by_key(df.select("id", F.dense_rank().over(Window.orderBy(F.desc_nulls_last("total")))), 1)
    assert by_key(dense_rank_desc(df, "total", "r").select("id", "r"), 1) == plain
    order = sorted({u for u in units if u is not None}, reverse=True)
    for i, u in enumerate(units):
        assert plain[(i,)] == (len(order) + 1 if u is None else order.index(u) + 1,)


def test_rank_of_whole_numbers_and_of_nothing(spark):
    df = spark.range(10).withColumn("v", F.col("id") % 3)
    assert by_key(dense_rank_desc(df, "v", "r").select("id", "r"), 1) == {(i,): (3 - i % 3,) for i in range(10)}
    assert dense_rank_desc(df.filter("id < 0"), "v", "r").count() == 0
    with pytest.raises(TypeError):
        dense_rank_desc(df.withColumn("v", F.col("v").cast("double")), "v", "r")

import datetime
import random

import pytest
from sales import LOADED, bronze, line, priced, random_lines

from tillflow.operators.dedupe import latest_per_key
from tillflow.operators.enrich import silver_rows
from tillflow.operators.quality import accepted, rejected
from tillflow.plans.medallion import to_silver
from tillflow.schemas import REASONS, SILVER

LATER = LOADED + datetime.timedelta(days=1)


def test_columns_and_types(spark):
    df = to_silver(bronze(spark, [line("T1")]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER]


def test_revenue_is_rounded_half_up_at_every_step(spark):
    lines = random_lines(5, 200) + [line("X1", quantity=1, price=0.05, discount=0.1), line("X2", quantity=3, price=1.115)]
    rows = {r["transaction_id"]: r for r in silver_rows(bronze(spark, lines)).collect()}
    for row in lines:
        out = rows[row["transaction_id"]]
        assert (out["gross_revenue"], out["discount_amount"], out["net_revenue"]) == priced(row)


def test_calendar(spark):
    days = ["2024-01-02", "2024-12-30", "2023-01-01", "2024-03-09"]
    rows = silver_rows(bronze(spark, [line(d, day=d) for d in days])).collect()
    got = {r["transaction_id"]: (r["year"], r["month"], r["week"], r["day_of_week"], r["is_weekend"]) for r in rows}
    assert got == {
        "2024-01-02": (2024, 1, 1, 3, False),
        "2024-12-30": (2024, 12, 1, 2, False),
        "2023-01-01": (2023, 1, 52, 1, True),
        "2024-03-09": (2024, 3, 10, 7, True),
    }


def test_rejected_rows_carry_every_reason(spark):
    lines = [
        line("good"),
        line(None),
        line("q0", quantity=0),
        line("q-", quantity=-1, price=0.0),
        line("qn", quantity=None),
        line("p", price=float("nan")),
        line("pinf", price=float("inf")),
        line("pbig", quantity=2**31 - 1, price=1e11),
        line("tiny", price=1e-7),
        line("qmin", quantity=-(2**31)),
        line("d", day="2024-13-99"),
        line("d3", day="2024-1-5"),
        line("d4", day=" 2024-01-05"),
        line("d5", day="2024-01-05T00:00:00"),
        line("d6", day="2024"),
        line("d7", day="2023-02-29"),
        line("d8", day="2024/02/29"),
        line("d9", day="abcd-ef-gh"),
        line("leap", day="2024-02-29"),
        line("max", quantity=2, price=4e12, discount=1000.0),
        line("d2", day="05.03.2024"),
        line("disc", discount=float("nan")),
        line("over", discount=1.5),
        line("free", discount=None, customer=None),
    ]
    df = bronze(spark, lines)
    reasons = {r["transaction_id"]: r[REASONS] for r in rejected(df).collect()}
    assert reasons == {
        None: ["missing_key"],
        "q0": ["bad_quantity"],
        "q-": ["bad_quantity", "bad_price"],
        "qn": ["bad_quantity"],
        "p": ["amount_out_of_range"],
        "pinf": ["amount_out_of_range"],
        "pbig": ["amount_out_of_range"],
        "tiny": ["amount_out_of_range"],
        "qmin": ["bad_quantity"],
        "d": ["bad_date"],
        "d3": ["bad_date"],
        "d4": ["bad_date"],
        "d5": ["bad_date"],
        "d6": ["bad_date"],
        "d7": ["bad_date"],
        "d8": ["bad_date"],
        "d9": ["bad_date"],
        "d2": ["bad_date"],
        "disc": ["amount_out_of_range"],
    }
    kept = {r["transaction_id"]: r for r in silver_rows(df).collect()}
    assert kept.keys() == {"good", "over", "free", "max", "leap"}
    assert kept["free"]["discount_amount"] == 0 and kept["over"]["net_revenue"] < 0
    strict = rejected(df, ["discount_out_of_range"])
    assert {r["transaction_id"] for r in strict.collect()} == reasons.keys() | {"over", "max"}
    assert silver_rows(df, strict=["discount_out_of_range"]).count() == 3
    with pytest.raises(ValueError, match="no_such_rule"):
        rejected(df, ["no_such_rule"])


def test_accepted_and_rejected_are_complements(spark):
    rng = random.Random(7)
    lines = [
        line(
            rng.choice([None, f"T{i}"]),
            day=rng.choice(["2024-01-01", "2024-02-30", None]),
            quantity=rng.choice([None, -1, 0, 3]),
            price=rng.choice([None, 0.0, -2.0, 5.0, float("nan"), 1e13]),
            discount=rng.choice([None, 0.1, 2.0, 5000.0, float("nan")]),
        )
        for i in range(3000)
    ]
    df = bronze(spark, lines)
    for strict in ([], ["discount_out_of_range", "corrupt_record"]):
        good, bad = accepted(df, strict), rejected(df, strict)
        assert good.count() + bad.count() == len(lines)
        assert good.count() > 0 and bad.filter(f"size({REASONS}) = 0").count() == 0


def test_latest_version_wins(spark):
    lines = [line("T1", quantity=1), line("T1", quantity=3, loaded=LATER), line("T2", quantity=5)]
    rows = silver_rows(bronze(spark, lines)).collect()
    assert {r["transaction_id"]: r["quantity"] for r in rows} == {"T1": 3, "T2": 5}


def test_unusable_correction_does_not_hide_the_last_usable_version(spark):
    lines = [line("T1", quantity=1), line("T1", quantity=0, loaded=LATER)]
    assert [r["quantity"] for r in silver_rows(bronze(spark, lines)).collect()] == [1]


def test_same_outcome_for_any_row_order_and_a_hot_key(spark):
    rng = random.Random(3)
    lines = [line("HOT", quantity=rng.randint(1, 50), price=rng.randint(1, 999) / 10) for _ in range(2000)]
    lines += [line(f"T{i % 700}", quantity=rng.randint(1, 9), loaded=rng.choice([LOADED, LATER])) for i in range(3000)]
    best = {}
    for row in lines:
        order = (row.get("loaded", LOADED), row["quantity"], row["unit_price"])
        best[row["transaction_id"]] = max(best.get(row["transaction_id"], order), order)
    for seed in (1, 2):
        random.Random(seed).shuffle(lines)
        df = latest_per_key(bronze(spark, lines).repartition(7), "transaction_id", "ingestion_timestamp")
        got = {r["transaction_id"]: (r["ingestion_timestamp"], r["quantity"], r["unit_price"]) for r in df.collect()}
        assert got == best


def test_redelivery_changes_nothing(spark):
    lines = random_lines(11, 80)
    once = silver_rows(bronze(spark, lines)).drop("ingestion_timestamp")
    twice = silver_rows(bronze(spark, lines + [r | {"loaded": LATER} for r in lines])).drop("ingestion_timestamp")
    assert once.exceptAll(twice).count() == 0 and twice.count() == once.count()

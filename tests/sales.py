"""Made-up sale lines for tests, and the plain-Python results they must give."""

import csv
import datetime
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tillflow.schemas import RAW

LOADED = datetime.datetime(2024, 6, 1, 12)


def line(key, day="2024-03-05", store=1, product=1, quantity=2, price=10.0, discount=0.1, customer="C1", **other):
    row = {
        "transaction_id": key,
        "date": day,
        "store_id": f"S{store:02}",
        "store_name": f"Store {store}",
        "store_region": ["North", "South", "East_1"][store % 3],
        "product_id": f"P{product:03}",
        "product_name": f"Product {product}",
        "category": ["Garden", "Kitchen", "Toys"][product % 3],
        "quantity": quantity,
        "unit_price": price,
        "discount_pct": discount,
        "customer_id": customer,
    }
    return row | other


def random_lines(seed, n=300):
    rng = random.Random(seed)
    first = datetime.date(2024, 12, 20)
    return [
        line(
            f"T{i:05}",
            day=(first + datetime.timedelta(days=rng.randrange(60))).isoformat(),
            store=rng.randrange(5),
            product=rng.randrange(12),
            quantity=rng.randint(1, 9),
            price=rng.randint(1, 40000) / 100,
            discount=rng.choice([None, 0.0, 0.05, 0.1, 0.125, 0.2]),
            customer=rng.choice([None, "C1", "C2", "C3", "C4"]),
        )
        for i in range(n)
    ]


def write_csv(path, lines, header=None):
    header = header or RAW.names
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, header)
        writer.writeheader()
        writer.writerows(lines)
    return str(path)


def bronze(spark, lines, loaded=LOADED):
    """A Bronze frame; a line may bring its own ``loaded`` time."""
    rows = [tuple(row[c] for c in RAW.names) + (row.get("loaded", loaded),) for row in lines]
    schema = RAW.simpleString()[len("struct<") : -1] + ",ingestion_timestamp:timestamp"
    return spark.createDataFrame(rows, schema).withColumn("_corrupt", F.lit(None).cast("string"))


def half_up(value, places="0.01"):
    return Decimal(value).quantize(Decimal(places), ROUND_HALF_UP)


def priced(row):
    gross = half_up(row["quantity"] * Decimal(str(row["unit_price"])))
    cut = half_up(gross * Decimal(str(row["discount_pct"] or 0)))
    return gross, cut, gross - cut


def grouped(lines, *keys):
    groups = defaultdict(list)
    for row in lines:
        groups[tuple(row[k] for k in keys)].append(row)
    return groups


def dense_ranks(totals):
    order = sorted(set(totals.values()), reverse=True)
    return {key: order.index(total) + 1 for key, total in totals.items()}


def expected_daily(lines):
    result = {}
    for (day, region), rows in grouped(lines, "date", "store_region").items():
        money = [priced(r) for r in rows]
        net = sum(m[2] for m in money)
        result[datetime.date.fromisoformat(day), region] = (
            float(net),
            float(sum(m[0] for m in money)),
            float(sum(m[1] for m in money)),
            sum(r["quantity"] for r in rows),
            len(rows),
            len({r["customer_id"] for r in rows} - {None}),
            float(half_up(net / len(rows))),
        )
    return result


def expected_products(lines):
    groups = grouped(lines, "product_id", "product_name", "category")
    totals = {key: sum(priced(r)[2] for r in rows) for key, rows in groups.items()}
    ranks = dense_ranks(totals)
    return {
        key: (
            float(totals[key]),
            sum(r["quantity"] for r in rows),
            float(half_up(sum(Decimal(str(r["unit_price"])) for r in rows) / len(rows))),
            float(half_up(100 * sum(Decimal(str(r["discount_pct"] or 0)) for r in rows) / len(rows))),
            len(rows),
            len({r["store_id"] for r in rows}),
            ranks[key],
        )
        for key, rows in groups.items()
    }


def expected_stores(lines):
    groups = grouped(lines, "store_id", "store_name", "store_region")
    totals = {key: sum(priced(r)[2] for r in rows) for key, rows in groups.items()}
    ranks = dense_ranks(totals)
    return {
        key: (
            float(totals[key]),
            sum(r["quantity"] for r in rows),
            len(rows),
            len({r["customer_id"] for r in rows} - {None}),
            float(half_up(totals[key] / len(rows))),
            len({r["product_id"] for r in rows}),
            ranks[key],
        )
        for key, rows in groups.items()
    }


def expected_trends(lines, iso=False):
    groups = defaultdict(list)
    for row in lines:
        day = datetime.date.fromisoformat(row["date"])
        iso_year, week, _ = day.isocalendar()
        groups[iso_year if iso else day.year, week, row["category"]].append(row)
    return {
        key: (
            float(sum(priced(r)[2] for r in rows)),
            sum(r["quantity"] for r in rows),
            len({r["product_id"] for r in rows}),
        )
        for key, rows in groups.items()
    }


def by_key(df, keys):
    """Collected rows as {key columns: other columns}; fails when a key repeats."""
    rows = df.collect()
    result = {tuple(r)[:keys]: tuple(r)[keys:] for r in rows}
    assert len(result) == len(rows)
    return result

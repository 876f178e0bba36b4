"""Stored tables over several runs: versions, quarantine, progress, refused files, leftovers."""

import datetime
import os

from sales import LOADED, bronze, line, write_csv

from tillflow.operators.enrich import silver_rows
from tillflow.plans import medallion
from tillflow.settings import configure
from tillflow.sources import staging
from tillflow.sources.lake import processed_until, read_bronze, read_quarantine, read_refused_files, read_silver
from tillflow.streaming import feeds


def quantities(spark, lake):
    return {r["transaction_id"]: r["quantity"] for r in read_silver(spark, lake).collect()}


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_feed_and_batch_in_either_order(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_csv(landing / "old.csv", [line("A", quantity=1), line("BAD", quantity=0)])
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    medallion.ingest(spark, lake, write_csv(tmp_path / "correction.csv", [line("A", quantity=9)]))
    medallion.refresh_silver(spark, lake)
    assert quantities(spark, lake) == {"A": 9}
    drain(feeds.feed_silver(spark, lake))
    assert quantities(spark, lake) == {"A": 9}, "the feed is older than the correction"
    medallion.refresh_silver(spark, lake)
    assert [r["transaction_id"] for r in read_quarantine(spark, lake).collect()] == ["BAD"], "one path, one rejection"


def test_quarantine_follows_the_rules_of_the_last_refresh(spark, lake, tmp_path):
    medallion.ingest(spark, lake, write_csv(tmp_path / "a.csv", [line("A", discount=1.5), line("B")]))
    for since in (None, "2000-01-01"):
        medallion.refresh_silver(spark, lake, since, strict=["discount_out_of_range"])
        assert [r["transaction_id"] for r in read_quarantine(spark, lake).collect()] == ["A"]
        medallion.refresh_silver(spark, lake, since)
        assert read_quarantine(spark, lake).count() == 0 and quantities(spark, lake) == {"A": 2, "B": 2}


def test_run_reads_new_loads_and_records_refused_files(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_csv(landing / "a.csv", [line("A")])
    assert processed_until(spark, lake) is None and read_refused_files(spark, lake).count() == 0
    medallion.run(spark, lake, str(landing))
    day = processed_until(spark, lake)
    assert isinstance(day, datetime.date)
    plan = read_bronze(spark, lake, day, feed=False)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pipeline_run_date" in plan
    (landing / "bad.csv").write_text("a,b,c\n1,2,3\n")
    load = medallion.run(spark, lake, str(landing))
    refused = read_refused_files(spark, lake).collect()
    assert [r["file"] for r in refused] == load.rejected_files and refused[0]["reason"] == "wrong header"
    assert quantities(spark, lake) == {"A": 2}


def test_merges_and_publications_leave_nothing_staged(spark, shared_folder, lake, tmp_path):
    def folders():
        base = f"{shared_folder}/{spark.sparkContext.applicationId}"
        return set(os.listdir(base)) if os.path.isdir(base) else set()

    medallion.run(spark, lake, write_csv(tmp_path / "a.csv", [line("A")]))
    before = folders()
    medallion.run(spark, lake, write_csv(tmp_path / "b.csv", [line("A", quantity=3), line("B")]))
    assert folders() == before
    kept = staging.staged(spark.range(3), "kept")
    with staging.cleared(spark):
        staging.staged(spark.range(3), "gone")
    assert len(folders() - before) == 1 and kept.count() == 3


def test_the_zone_of_the_machine_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_large_amounts_pass_and_keep_their_value(spark):
    lines = [line("price", price=2e12, quantity=1), line("discount", discount=1000.0), line("small", price=1e-6, quantity=1)]
    rows = {r["transaction_id"]: r for r in silver_rows(bronze(spark, lines, LOADED)).collect()}
    assert rows["price"]["gross_revenue"] == 2 * 10**12 and rows["discount"]["discount_amount"] == 20_000
    assert float(rows["small"]["unit_price"]) == 1e-6

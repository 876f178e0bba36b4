import pytest
from sales import line, random_lines, write_csv

from tillflow.plans import medallion
from tillflow.sources.lake import read_bronze, read_quarantine, read_refused_files, read_silver
from tillflow.sources.staging import remove
from tillflow.streaming import feeds


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_every_file_is_picked_up_once(spark, lake, landing):
    write_csv(landing / "a.csv", random_lines(61, 30))
    for _ in range(2):
        drain(feeds.feed_bronze(spark, lake, str(landing)))
        assert read_bronze(spark, lake).count() == 30
    write_csv(landing / "b.csv", [line("NEW1"), line("BAD", quantity=0)])
    write_csv(landing / "c.csv", [line("NEW2")])
    drain(feeds.feed_bronze(spark, lake, str(landing), max_files=1))
    assert read_bronze(spark, lake).count() == 33
    write_csv(landing.parent / "batch.csv", [line("BATCH")])
    medallion.ingest(spark, lake, str(landing.parent / "batch.csv"))
    assert read_bronze(spark, lake).count() == 34, "batch loads stay visible next to the feed"


def test_silver_follows_bronze(spark, lake, landing):
    write_csv(landing / "a.csv", [line("A", quantity=1), line("B", quantity=0)])
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    drain(feeds.feed_silver(spark, lake))
    write_csv(landing / "b.csv", [line("A", quantity=5, day="2024-05-01"), line("C")])
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    for _ in range(2):
        drain(feeds.feed_silver(spark, lake, max_files=1))
        silver = {r["transaction_id"]: (r["quantity"], r["month"]) for r in read_silver(spark, lake).collect()}
        assert silver == {"A": (5, 5), "C": (2, 3)}
        rejects = read_quarantine(spark, lake).collect()
        assert [(r["transaction_id"], r["reject_reasons"]) for r in rejects] == [("B", ["bad_quantity"])]


def test_replayed_batch_leaves_the_same_tables(spark, lake, landing, monkeypatch):
    write_csv(landing / "a.csv", [line("A"), line("B", quantity=-1)])
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    original = feeds.overwrite_partitions

    def fail_after(*args):
        original(*args)
        raise OSError("lost before the batch was recorded")

    monkeypatch.setattr(feeds, "overwrite_partitions", fail_after)
    with pytest.raises(Exception, match="lost before"):
        feeds.feed_silver(spark, lake).awaitTermination()
    monkeypatch.undo()
    drain(feeds.feed_silver(spark, lake))
    assert read_silver(spark, lake).count() == 1
    assert read_quarantine(spark, lake).count() == 1


def test_bad_file_is_refused_and_the_feed_goes_on(spark, lake, landing):
    (landing / "bad.csv").write_text("a,b,c\n1,2,3\n")
    write_csv(landing / "good.csv", random_lines(5, 12))
    for _ in range(2):
        drain(feeds.feed_bronze(spark, lake, str(landing)))
        assert read_bronze(spark, lake).count() == 12
        refused = read_refused_files(spark, lake).collect()
        assert [(r["file"].rsplit("/", 1)[1], r["reason"]) for r in refused] == [("bad.csv", "wrong header")]
    write_csv(landing / "later.csv", [line("LATER")])
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    drain(feeds.feed_silver(spark, lake))
    assert read_bronze(spark, lake).count() == 13 and read_silver(spark, lake).count() == 13


def test_replayed_load_replaces_its_rows(spark, lake, landing, monkeypatch):
    for name in ("a.csv", "b.csv"):
        write_csv(landing / name, random_lines(len(name), 10))
    original = feeds.take_in

    def fail_after(*args):
        original(*args)
        raise OSError("lost before the batch was recorded")

    monkeypatch.setattr(feeds, "take_in", fail_after)
    with pytest.raises(Exception, match="lost before"):
        feeds.feed_bronze(spark, lake, str(landing)).awaitTermination()
    monkeypatch.undo()
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    assert read_bronze(spark, lake).count() == 20


def test_lost_checkpoint_loads_nothing_twice(spark, lake, landing):
    write_csv(landing / "a.csv", random_lines(1, 10))
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    remove(spark, lake.checkpoint("files"))
    write_csv(landing / "b.csv", [line("B")])
    drain(feeds.feed_bronze(spark, lake, str(landing)))
    assert read_bronze(spark, lake).count() == 11

import datetime

import pytest
from sales import line, random_lines, write_csv

from tillflow.plans import medallion
from tillflow.schemas import BRONZE, RAW
from tillflow.sinks import loads
from tillflow.sources.lake import Lake, read_bronze, read_ledger, read_refused_files
from tillflow.sources.landing import file_headers, read_csv


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def test_load_appends_rows_as_they_are(spark, lake, landing):
    write_csv(landing / "a.csv", random_lines(1, 20))
    write_csv(landing / "b.csv", random_lines(2, 5))
    assert medallion.ingest(spark, lake, str(landing)) == medallion.Load(25)
    assert medallion.ingest(spark, lake, str(landing / "b.csv"), again=True).row_count == 5
    bronze = read_bronze(spark, lake)
    assert set(bronze.columns) == set(BRONZE.names)
    files = {r["source_file"].rsplit("/", 1)[1]: r["count"] for r in bronze.groupBy("source_file").count().collect()}
    assert files == {"a.csv": 20, "b.csv": 10}
    today = bronze.select("pipeline_run_date").distinct().first()[0]
    assert read_bronze(spark, lake, today).count() == 30
    assert read_bronze(spark, lake, "2099-01-01").count() == 0


def test_malformed_lines_are_kept_and_marked(spark, landing):
    path = landing / "a.csv"
    write_csv(path, [line("T1"), line("T2", quantity="two"), line("T4", discount="")])
    with open(path, "a") as out:
        out.write("T3,2024-01-01,S\n")
    rows = {r["transaction_id"]: r for r in read_csv(spark, str(path)).collect()}
    assert rows["T1"]["_corrupt"] is None and rows["T4"]["_corrupt"] is None
    assert rows["T2"]["quantity"] is None and "two" in rows["T2"]["_corrupt"]
    assert rows["T3"]["_corrupt"] == "T3,2024-01-01,S"
    assert rows["T4"]["discount_pct"] is None


def test_file_with_reordered_header_is_left_out_whole(spark, lake, landing):
    write_csv(landing / "good + 1%.csv", random_lines(3, 7))
    names = list(RAW.names)
    names[3], names[4] = names[4], names[3]
    write_csv(landing / "shifted.csv", random_lines(4, 7), names)
    headers = {r["file"].rsplit("/", 1)[1]: r["ok"] for r in file_headers(spark, str(landing)).collect()}
    assert headers == {"good + 1%.csv": True, "shifted.csv": False}
    load = medallion.ingest(spark, lake, str(landing))
    assert load.row_count == 7
    assert [f.rsplit("/", 1)[1] for f in load.rejected_files] == ["shifted.csv"]
    assert read_bronze(spark, lake).count() == 7


def test_delivery_of_wrong_headers_only(spark, lake, landing):
    (landing / "bad.csv").write_text("a,b,c\n1,2,3\n")
    load = medallion.ingest(spark, lake, str(landing))
    assert load.row_count == 0 and len(load.rejected_files) == 1


def test_known_files_are_passed_over_until_replaced(spark, lake, landing):
    write_csv(landing / "a [1] {x}*.csv", random_lines(1, 20))
    (landing / "bad.csv").write_text("a,b,c\n1,2,3\n")
    (landing / "empty.csv").write_text("")
    first = medallion.ingest(spark, lake, str(landing))
    assert first.row_count == 20 and [f.rsplit("/", 1)[1] for f in first.rejected_files] == ["bad.csv"]
    for _ in range(2):
        assert medallion.ingest(spark, lake, str(landing)) == medallion.Load(0)
    write_csv(landing / "a [1] {x}*.csv", random_lines(1, 3))
    write_csv(landing / "bad.csv", random_lines(2, 4))
    assert medallion.ingest(spark, lake, str(landing)) == medallion.Load(7)
    assert read_bronze(spark, lake).count() == 27
    lines = {(r["path"].rsplit("/", 1)[1], r["verdict"]) for r in read_ledger(spark, lake).collect()}
    assert lines == {("a [1] {x}*.csv", "loaded"), ("bad.csv", "refused"), ("bad.csv", "loaded")}, "there is nothing in empty files"


def test_delivery_in_several_loads(spark, lake, landing, monkeypatch):
    monkeypatch.setattr(medallion, "FILES_AT_ONCE", 2)
    monkeypatch.setattr(medallion, "NAMED_FILES", 1)
    for i in range(5):
        write_csv(landing / f"{i}.csv", [line(f"T{i}{j}") for j in range(i + 1)])
    for name in ("bad1.csv", "bad2.csv"):
        (landing / name).write_text("a\n1\n")
    load = medallion.ingest(spark, lake, str(landing))
    assert load.row_count == 15 and len(load.rejected_files) == 1
    assert read_refused_files(spark, lake).count() == 2 and read_ledger(spark, lake).select("load").distinct().count() == 4


@pytest.mark.parametrize("point", ["_replace", "remove"])
def test_interrupted_load_is_taken_back_or_finished(spark, lake, landing, monkeypatch, point):
    write_csv(landing / "a.csv", random_lines(1, 20))
    original, calls = getattr(loads, point), []

    def interrupted(*args):
        calls.append(args)
        if point == "remove" or len(calls) == 3:  # before the ledger is written, or after
            raise OSError("lost")
        return original(*args)

    monkeypatch.setattr(loads, point, interrupted)
    with pytest.raises(OSError, match="lost"):
        medallion.ingest(spark, lake, str(landing))
    monkeypatch.undo()
    assert read_bronze(spark, lake).count() == 20
    for _ in range(2):
        medallion.ingest(spark, lake, str(landing))
        assert read_bronze(spark, lake).count() == 20


def test_interrupted_delta_load_is_deleted(spark, tmp_path, monkeypatch):
    """The package is absent here, so only the statement can be checked."""
    lake = Lake(str(tmp_path), "delta")
    loads._begin(spark, lake, lake.bronze, "load-1")
    (tmp_path / "bronze" / "sales" / "_delta_log").mkdir(parents=True)
    statements = []
    monkeypatch.setattr(type(spark), "sql", lambda self, text: statements.append(text))
    loads.recover(spark, lake, lake.bronze)
    monkeypatch.undo()
    assert statements == [f"DELETE FROM delta.`{lake.bronze}` WHERE load = 'load-1'"]
    assert "DeleteFromTable" in spark._jsparkSession.sessionState().sqlParser().parsePlan(statements[0]).toString()


def test_other_failures_are_not_swallowed(spark, lake, landing):
    with pytest.raises(Exception, match="(?i)path"):
        medallion.ingest(spark, lake, str(landing / "nothing-here"))


def test_missing_layers_are_named(spark, lake):
    with pytest.raises(FileNotFoundError, match="Bronze"):
        read_bronze(spark, lake)
    with pytest.raises(FileNotFoundError, match="Silver"):
        medallion.refresh_gold(spark, lake)


def test_run_date_is_the_day_of_the_load(spark, lake, landing):
    write_csv(landing / "a.csv", [line("T1")])
    medallion.ingest(spark, lake, str(landing))
    row = read_bronze(spark, lake).first()
    assert row["pipeline_run_date"] == row["ingestion_timestamp"].date()
    assert isinstance(row["pipeline_run_date"], datetime.date)

import datetime
import itertools
import os
import random

import pytest
from sales import LOADED, bronze, line, random_lines, write_csv

from tillflow.plans import medallion
from tillflow.schemas import SILVER, SILVER_PARTITIONS
from tillflow.sinks import upsert as upsert_module
from tillflow.sinks.upsert import recover, upsert
from tillflow.sources.lake import Lake, in_partitions, read_quarantine, read_silver, stored

KEY = "transaction_id"


_loads = itertools.count()


def put(spark, path, lines, loaded=None):
    """Merge lines as a delivery that is later than all before, unless told otherwise."""
    loaded = loaded or LOADED + datetime.timedelta(minutes=next(_loads))
    upsert(medallion.to_silver(bronze(spark, lines, loaded)), path, KEY, SILVER_PARTITIONS)


def content(spark, path):
    rows = stored(spark, path, SILVER).drop("silver_processed_at").collect()
    assert len({r[KEY] for r in rows}) == len(rows), "a key is stored twice"
    return {r[KEY]: (str(r["date"]), r["quantity"], r["year"], r["month"]) for r in rows}


def expected(lines):
    return {
        r[KEY]: (r["date"], r["quantity"], int(r["date"][:4]), int(r["date"][5:7])) for r in lines
    }


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_update_insert_and_leave_alone(spark, tmp_path):
    path = str(tmp_path / "silver")
    assert stored(spark, path, SILVER) is None
    put(spark, path, [line("A", quantity=1), line("B", quantity=2), line("C", day="2023-07-01")])
    july = files(f"{path}/year=2023")
    put(spark, path, [line("A", quantity=9), line("D", day="2024-04-01")])
    assert content(spark, path) == expected(
        [line("A", quantity=9), line("B", quantity=2), line("C", day="2023-07-01"), line("D", day="2024-04-01")]
    )
    assert files(f"{path}/year=2023") == july, "an untouched partition was rewritten"


def test_row_that_moves_to_another_month_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, path, [line("A", day="2024-01-31"), line("B", day="2024-02-01")])
    put(spark, path, [line("A", day="2024-02-02")])
    assert content(spark, path) == expected([line("A", day="2024-02-02"), line("B", day="2024-02-01")])


def test_an_older_version_never_replaces_a_newer_one(spark, tmp_path):
    path, hour = str(tmp_path / "silver"), datetime.timedelta(hours=1)
    put(spark, path, [line("A", quantity=5, day="2024-02-01"), line("B", quantity=1)], LOADED)
    put(spark, path, [line("A", quantity=9, day="2024-05-01"), line("B", quantity=2)], LOADED - hour)
    assert content(spark, path) == expected([line("A", quantity=5, day="2024-02-01"), line("B", quantity=1)])
    put(spark, path, [line("A", quantity=7)], LOADED + hour)
    assert content(spark, path) == expected([line("A", quantity=7), line("B", quantity=1)])


def test_thousands_of_touched_months(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, path, [line("A"), line("B", day="2023-01-01")])
    wanted = [{"year": y, "month": m} for y in range(1850, 2024) for m in range(1, 13)]
    found = stored(spark, path, SILVER).filter(in_partitions(wanted, SILVER_PARTITIONS))
    assert len(wanted) > 2000 and [r[KEY] for r in found.collect()] == ["B"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws(/" in plan, "months are pruned"


def test_same_batch_twice_is_a_no_op(spark, tmp_path):
    path = str(tmp_path / "silver")
    lines = random_lines(31, 60)
    put(spark, path, lines)
    put(spark, path, lines)
    assert content(spark, path) == expected(lines)


def test_random_batches_against_a_dictionary(spark, tmp_path):
    rng, path, model = random.Random(8), str(tmp_path / "silver"), {}
    for _ in range(4):
        keys = rng.sample(range(60), 25)
        batch = [line(f"T{k}", day=f"2024-{rng.randint(1, 6):02}-11", quantity=rng.randint(1, 9)) for k in keys]
        put(spark, path, batch)
        model |= {r[KEY]: r for r in batch}
        assert content(spark, path) == expected(model.values())


@pytest.mark.parametrize("broken", ["overwrite_partitions", "_set_state"])
def test_interrupted_swap_is_finished_by_the_next_call(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "silver")
    put(spark, path, [line("A", day="2024-01-31"), line("B", day="2024-02-01")])
    original = getattr(upsert_module, broken)

    def fail(*args):
        if broken == "_set_state" and args[-1] == "publishing":
            return original(*args)
        raise OSError("driver lost")

    monkeypatch.setattr(upsert_module, broken, fail)
    with pytest.raises(OSError):
        put(spark, path, [line("A", day="2024-02-02", quantity=7)])
    monkeypatch.undo()
    moved = [line("A", day="2024-02-02", quantity=7), line("B", day="2024-02-01")]
    assert recover(spark, path, SILVER, SILVER_PARTITIONS, KEY)
    assert content(spark, path) == expected(moved)
    assert not recover(spark, path, SILVER, SILVER_PARTITIONS, KEY)
    put(spark, path, [line("C")])
    assert content(spark, path) == expected([*moved, line("C")])


def test_partitions_must_be_whole_numbers(spark, tmp_path):
    with pytest.raises(TypeError, match="store_region"):
        upsert(medallion.to_silver(bronze(spark, [line("A")])), str(tmp_path / "s"), KEY, ["store_region"])


def test_delta_needs_its_package(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)delta"):
        upsert(medallion.to_silver(bronze(spark, [line("A")])), str(tmp_path / "s"), KEY, SILVER_PARTITIONS, "delta")


def test_delta_merge_statement(spark, tmp_path, monkeypatch):
    """The package is absent here, so only the statement itself can be checked."""
    statements = []
    monkeypatch.setattr(upsert_module, "stored", lambda *args: spark.createDataFrame([], SILVER))
    monkeypatch.setattr(type(spark), "sql", lambda self, text: statements.append(text))
    upsert(medallion.to_silver(bronze(spark, [line("A")])), str(tmp_path / "s"), KEY, SILVER_PARTITIONS, "delta")
    monkeypatch.undo()
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(statements[0]).toString()
    assert "MergeIntoTable" in parsed and "updatestaraction" in parsed and "insertstaraction" in parsed


def test_refresh_silver_over_deliveries(spark, lake, tmp_path):
    first, second = tmp_path / "1.csv", tmp_path / "2.csv"
    write_csv(first, [line("A", quantity=1), line("B", day="2024-02-30"), line("C", quantity="two")])
    write_csv(second, [line("A", quantity=3), line("D")])
    assert read_quarantine(spark, lake).count() == 0
    medallion.ingest(spark, lake, str(first))
    medallion.refresh_silver(spark, lake)
    assert content(spark, lake.silver) == expected([line("A", quantity=1)])
    medallion.ingest(spark, lake, str(second))
    for _ in range(2):
        medallion.refresh_silver(spark, lake)
        assert content(spark, lake.silver) == expected([line("A", quantity=3), line("D")])
        rejects = read_quarantine(spark, lake).collect()
        assert {r[KEY]: r["reject_reasons"] for r in rejects} == {
            "B": ["bad_date"],
            "C": ["bad_quantity", "corrupt_record"],
        }
        assert len(rejects) == 2
    medallion.refresh_silver(spark, lake, since="2099-01-01")
    assert content(spark, lake.silver) == expected([line("A", quantity=3), line("D")])
    assert len(read_quarantine(spark, lake).collect()) == 2


def test_silver_reads_back_with_its_fixed_schema(spark, tmp_path):
    lake = Lake(str(tmp_path))
    put(spark, lake.silver, [line("A", loaded=LOADED + datetime.timedelta(days=1))])
    assert {f.name: f.dataType for f in read_silver(spark, lake).schema} == {f.name: f.dataType for f in SILVER}


def test_swap_copies_the_laid_out_rows_without_another_shuffle(spark, tmp_path, monkeypatch):
    """Rows and keys were laid out beside the table; swapping them in does not rebalance them again."""
    from tillflow.sinks import directory

    path = str(tmp_path / "silver")
    put(spark, path, [line("A", day="2024-01-31"), line("B", day="2024-02-01")])
    calls = []

    def watched(original):
        def write(df, path, partition_by, sort_by=(), laid_out=False):
            calls.append(laid_out)
            return original(df, path, partition_by, sort_by, laid_out)

        return write

    monkeypatch.setattr(upsert_module, "overwrite_partitions", watched(upsert_module.overwrite_partitions))
    monkeypatch.setattr(directory, "overwrite_partitions", watched(directory.overwrite_partitions))
    put(spark, path, [line("A", day="2024-02-02", quantity=7)])
    assert calls == [True, True]
    assert content(spark, path) == expected([line("A", day="2024-02-02", quantity=7), line("B", day="2024-02-01")])

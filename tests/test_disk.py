"""What stays on disk, and what shuffles carry."""

import os
import time

from compare import registered
from pyspark.sql import functions as F
from sales import LOADED, bronze, line
from test_plans import plan
from test_plans import stored_bronze  # noqa: F401
from test_upsert import content, expected, files, put

from tillflow.operators import distincts
from tillflow.plans import medallion
from tillflow.schemas import DERIVED, RAW, SILVER
from tillflow.settings import configure
from tillflow.sinks import upsert as upsert_module
from tillflow.sources.lake import read_silver


def shuffles(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(found.apply(i)) for i in range(found.size()) if "shuffle_" in str(found.apply(i))}


def test_shuffle_files_go_when_their_query_ends(spark, tmp_path):
    configure(spark)
    before = shuffles(spark)
    spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "out"))
    for _ in range(50):  # they are deleted in the background
        if not (left := shuffles(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    again = spark.range(100).repartition(3, "id")
    assert len(again.collect()) == len(again.collect()) == 100, "a second run has its shuffle made again"


def test_file_names_stay_out_of_the_shuffle(stored_bronze):  # noqa: F811
    assert "source_file" not in plan(medallion.to_silver(stored_bronze), "extended").split("Physical Plan")[1]


def test_derived_columns_are_made_after_the_rows_are_laid_out(spark, lake, monkeypatch):
    laid_out, original = [], upsert_module.overwrite

    def watched(df, *args, **options):
        laid_out.append(df.columns)
        return original(df, *args, **options)

    monkeypatch.setattr(upsert_module, "overwrite", watched)
    for quantity in (1, 3):
        rows = medallion.to_silver(bronze(spark, [line("A", quantity=quantity, day="2024-01-31")]))
        medallion.merge_into_silver(spark, lake, rows)
    assert laid_out and not any(set(DERIVED) & set(columns) for columns in laid_out)
    stored = read_silver(spark, lake)
    assert set(stored.columns) == set(SILVER.names)
    assert stored.drop("silver_processed_at").select(*rows.drop("silver_processed_at").columns).collect() == (
        rows.drop("silver_processed_at").collect()
    )


def test_rows_that_are_stored_already_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "silver")
    lines = [line("A", day="2023-07-01"), line("B", day="2024-02-01"), line("C", day="2024-03-01", quantity=4)]
    put(spark, path, lines, LOADED)
    before = {month: files(f"{path}/year={month}") for month in ("2023", "2024/month=2", "2024/month=3")}
    put(spark, path, lines, LOADED)
    assert all(files(f"{path}/year={month}") == found for month, found in before.items())
    lines[2] = line("C", day="2024-03-01", quantity=5)
    put(spark, path, lines, LOADED)
    assert content(spark, path) == expected(lines)
    assert files(f"{path}/year=2023") == before["2023"]
    assert files(f"{path}/year=2024/month=3") != before["2024/month=3"]


def test_nothing_of_a_finished_merge_lies_beside_the_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    for quantity in (1, 2):
        put(spark, path, [line("A", quantity=quantity)])
    assert os.listdir(f"{path}__pending") == ["state"]


def test_digests_tell_nulls_lengths_and_times_apart(spark):
    values = "('a', NULL), (NULL, 'a'), ('1:a', ''), ('', '1:a'), ('-', NULL), (NULL, '-'), (NULL, NULL)"
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t(x, y)")
    assert rows.select(upsert_module._digest(rows, ["x", "y"]).alias("d")).distinct().count() == rows.count()
    times = spark.sql("SELECT timestamp_micros(id) AS t FROM range(3)")
    assert times.select(upsert_module._digest(times, ["t"]).alias("d")).distinct().count() == 3


def test_numbers_are_shuffled_rather_than_bitmaps(spark):
    rows = spark.range(200).select((F.col("id") % 3).alias("day"), F.col("id").cast("string").alias("who"))
    numbers = rows.select("who", F.monotonically_increasing_id().alias(distincts.NUMBER))
    text = plan(distincts.bitmaps(rows, ["day"], "who", numbers), "simple")
    whole, partial = text.index("[bitmap_construct_agg("), text.index("[partial_bitmap_construct_agg(")
    assert "Exchange" not in text[whole:partial]


def test_deliveries_are_packed(spark, tmp_path):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW)
    lines = spark.createDataFrame([tuple(line("A")[c] for c in RAW.names)], schema)
    landing = registered._landed(spark, lines, str(tmp_path))
    assert all(name.endswith(".csv.gz") for name in os.listdir(landing) if name.startswith("part"))


def test_rows_are_off_the_shuffle_before_they_are_laid_out(spark, tmp_path, monkeypatch):
    labels, original = [], upsert_module.staged
    monkeypatch.setattr(upsert_module, "staged", lambda df, label: labels.append(label) or original(df, label))
    put(spark, str(tmp_path / "silver"), [line("A", quantity=1)])
    assert labels == ["upsert"]
    put(spark, str(tmp_path / "silver"), [line("A", quantity=2)])
    assert labels[-1] == "merged"
    assert content(spark, str(tmp_path / "silver")) == expected([line("A", quantity=2)])

"""Loads into Bronze: every file of a delivery once, whole or not at all, and on record.

The ledger has a line for each file that was loaded or refused.  A load first notes that it
begins, then writes its rows into a partition of its own, then its lines into the ledger;
what an interrupted one has left is known from its note.  One writer at a time and target.
"""

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.schemas import BRONZE_PARTITIONS
from tillflow.sources.lake import LEDGER, LOADED, REFUSED, Lake, exists, read_ledger, stored
from tillflow.sources.landing import file_headers, normal_path, read_csv, with_load_metadata
from tillflow.sources.staging import remove

LOAD = "load"
FILES_AT_ONCE = 10_000  # whose names the driver holds, as it must to have Spark read them
_BEGUN = StructType().add("target", "string").add("loaded_at", "long").add(LOAD, "string")  # microseconds


def new_files(spark: SparkSession, lake: Lake, listing: DataFrame, besides: str | None = None) -> DataFrame:
    """Files of a listing (path, length, modified) that the ledger does not have as they are.

    A file that was replaced by another one is new.  besides: a load whose own lines don't count.
    """
    known = read_ledger(spark, lake)
    if besides is not None:
        known = known.where(F.col(LOAD) != besides)
    return listing.join(known, ["path", "length", "modified"], "left_anti")


def take_in(spark: SparkSession, lake: Lake, files: list[Row], target: str, load: str) -> tuple[int, list[str]]:
    """Write the rows of ``files`` into Bronze and their lines into the ledger; number of rows, and files refused.

    Spark checks every header while it reads, and fails before anything is committed, so good
    files are read once.  Only then are the headers looked at, and files with a wrong one left
    out whole.  A load that is repeated under its name replaces what it wrote before.
    """
    loaded_at, again = _begin(spark, lake, target, load)
    if again:
        _clear(spark, lake, target, loaded_at, load)
    paths = [f["path"] for f in files]
    bad: set[str] = set()
    try:
        rows = _written(spark, lake, paths, target, load, loaded_at)
    except Exception:
        headers = file_headers(spark, [literal(p) for p in paths]).where("NOT ok").select("file")
        bad = {normal_path(r["file"]) for r in headers.collect()}
        if not bad:
            raise
        _clear(spark, lake, target, loaded_at, load)
        rows = _written(spark, lake, [p for p in paths if normal_path(p) not in bad], target, load, loaded_at)
    lines = [
        (f["path"], f["length"], f["modified"], *((REFUSED, "wrong header") if normal_path(f["path"]) in bad else (LOADED, None)))
        for f in files
    ]
    ledger = spark.createDataFrame(lines, "path string, length bigint, modified bigint, verdict string, reason string")
    ledger = ledger.withColumns({"loaded_at": F.timestamp_micros(F.lit(loaded_at)), LOAD: F.lit(load)}).select(*LEDGER.names)
    _replace(ledger.coalesce(1), lake.ledger, [LOAD])
    remove(spark, f"{lake.begun_loads}/{LOAD}={load}")
    return rows, sorted(p for p in paths if normal_path(p) in bad)


def recover(spark: SparkSession, lake: Lake, target: str) -> None:
    """Take away the rows of interrupted loads into ``target``; their files are still new."""
    begun = stored(spark, lake.begun_loads, _BEGUN)
    if begun is None:
        return
    done = read_ledger(spark, lake).select(LOAD).distinct().withColumn("done", F.lit(True))
    # One line for each load that was interrupted since the last call.
    for note in begun.where(F.col("target") == target).join(done, LOAD, "left").collect():
        if not note["done"]:
            _clear(spark, lake, target, note["loaded_at"], note[LOAD])
        remove(spark, f"{lake.begun_loads}/{LOAD}={note[LOAD]}")


def literal(path: str) -> str:
    """A path that Spark would take for a pattern, as itself."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in path)


def _begin(spark: SparkSession, lake: Lake, target: str, load: str) -> tuple[int, bool]:
    """The time of the load, and whether it had begun before."""
    begun = stored(spark, lake.begun_loads, _BEGUN)
    note = begun and begun.where((F.col(LOAD) == load) & (F.col("target") == target)).first()
    if note:
        return note["loaded_at"], True
    now = F.unix_micros(F.current_timestamp()).alias("loaded_at")
    now = spark.range(1).select(F.lit(target).alias("target"), now, F.lit(load).alias(LOAD))
    _replace(now.coalesce(1), lake.begun_loads, [LOAD])
    return stored(spark, lake.begun_loads, _BEGUN).where(F.col(LOAD) == load).first()["loaded_at"], False


def _written(spark: SparkSession, lake: Lake, paths: list[str], target: str, load: str, loaded_at: int) -> int:
    if not paths:
        return 0
    rows = with_load_metadata(read_csv(spark, [literal(p) for p in paths]), F.timestamp_micros(F.lit(loaded_at))).withColumn(LOAD, F.lit(load))
    counted = Observation("load")
    rows = rows.observe(counted, F.count(F.lit(1)).alias("row_count"))
    if _is_delta(lake, target):  # Delta knows a repeated append by its name
        once = rows.write.format("delta").mode("append").option("txnAppId", load).option("txnVersion", 1)
        once.partitionBy(*BRONZE_PARTITIONS, LOAD).save(target)
    else:
        _replace(rows, target, [*BRONZE_PARTITIONS, LOAD])
    return counted.get["row_count"]


def _replace(rows: DataFrame, path: str, partition_by: list[str]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def _clear(spark: SparkSession, lake: Lake, target: str, loaded_at: int, load: str) -> None:
    if _is_delta(lake, target):
        if exists(spark, f"{target}/_delta_log"):
            spark.sql(f"DELETE FROM delta.`{target}` WHERE {LOAD} = '{load}'")
        return
    day = spark.range(1).select(F.timestamp_micros(F.lit(loaded_at)).cast("date").cast("string").alias("day")).first()["day"]
    remove(spark, f"{target}/{BRONZE_PARTITIONS[0]}={day}/{LOAD}={load}")


def _is_delta(lake: Lake, target: str) -> bool:
    return lake.table_format == "delta" and target == lake.bronze

"""What may go: Gold versions that nobody reads any more, and folders that ended applications have left."""

import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.gold_tables import TABLES
from tillflow.sources.lake import Lake, gold_versions, stored
from tillflow.sources.staging import remove, shared_folder

READER = "reader"
HOURS = 24
_READERS = StructType().add("version", "string").add("until", "timestamp").add(READER, "string")


def register_reader(spark: SparkSession, lake: Lake, version: str, hours: float = HOURS) -> str:
    """Keep a Gold version until the reader is released or the hours are over."""
    reader = uuid.uuid4().hex
    until = F.timestamp_micros(F.unix_micros(F.current_timestamp()) + F.lit(int(hours * 3_600_000_000)))
    line = spark.range(1).select(F.lit(version).alias("version"), until.alias("until"))
    line.coalesce(1).write.parquet(f"{lake.gold_readers}/{READER}={reader}")
    return reader


def release_reader(spark: SparkSession, lake: Lake, reader: str) -> None:
    remove(spark, f"{lake.gold_readers}/{READER}={reader}")


def _folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and times (milliseconds) of what lies in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [(f.getPath().getName(), f.getModificationTime()) for f in system.listStatus(folder)]


def expire_gold(spark: SparkSession, lake: Lake, keep: int = 2, hours: float = HOURS) -> list[str]:
    """Delete Gold versions but the last ``keep``, those that a reader holds, and what is younger than ``hours``.

    Also goes what publications that failed have left; one that is under way is younger.
    Returns the versions that went.  The driver sees a line for each version and reader.
    """
    published = [r["version"] for r in gold_versions(spark, lake).select("version").collect()]
    readers = stored(spark, lake.gold_readers, _READERS)
    held = set(published[: max(keep, 1)])
    if readers is not None:
        live = F.col("until") > F.current_timestamp()
        held |= {r["version"] for r in readers.where(live).select("version").distinct().collect()}
        for row in readers.where(~live).select(READER).distinct().collect():
            release_reader(spark, lake, row[READER])
    before, gone = time.time() * 1000 - hours * 3_600_000, set()
    for table in TABLES:
        for name, changed in _folders(spark, f"{lake.base}/gold/{table}"):
            version = name.removeprefix("version=")
            if version not in held and changed < before:
                remove(spark, lake.gold(version, table))
                gone.add(version)
    return sorted(gone)


def expire_staged(spark: SparkSession, hours: float = 7 * HOURS) -> list[str]:
    """Delete folders of other applications in the shared folder that are older than ``hours``."""
    base, before = shared_folder(spark), time.time() * 1000 - hours * 3_600_000
    own = spark.sparkContext.applicationId
    # Only names that Spark gives applications; others may keep things there too.
    old = [n for n, changed in _folders(spark, base) if changed < before and n != own and n.startswith(("app-", "application_", "local-", "spark-"))]
    for name in old:
        remove(spark, f"{base}/{name}")
    return sorted(old)

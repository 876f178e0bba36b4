"""CSV landings: reading, header checks and load metadata."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import CORRUPT, RAW, RAW_WITH_CORRUPT

# enforceSchema=false makes Spark compare the header of every file with the
# schema; by default it would bind columns by position and shift the data.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw sale lines; the text of a malformed line is kept in the corrupt column."""
    return spark.read.schema(RAW_WITH_CORRUPT).options(**CSV_OPTIONS).csv(paths)


def list_files(spark: SparkSession, source: str) -> DataFrame:
    """``path``, ``length`` and ``modified`` of every file with content at a folder, file or pattern; nothing is read."""
    return as_listing(spark.read.format("binaryFile").load(source))


def as_listing(files: DataFrame) -> DataFrame:
    """The listing columns of the binary file source; times in milliseconds."""
    return files.select("path", "length", F.unix_millis("modificationTime").alias("modified"))


def normal_path(path: str) -> str:
    """One spelling for local paths, which come with one slash after the scheme or with three."""
    return path.replace(":///", ":/")


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """First line of every CSV file and whether it is the expected header.

    Names are plain paths, not URLs.  Files are scanned as text where they lie.  Only the task holding the start of
    a file sees its first line, so ``first`` has a single candidate per file.  A file without a line has no row.
    """
    expected = ",".join(RAW.names)
    lines = (
        spark.read.text(path)
        .select(
            F.col("value"),
            F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        .filter("start = 0")
    )
    header = F.regexp_replace(F.first("value"), '[" ﻿\r]', "")
    return lines.groupBy("file").agg(header.alias("header")).withColumn("ok", F.lower("header") == expected)


def with_load_metadata(df: DataFrame, loaded_at: Column | None = None, source_file: Column | None = None) -> DataFrame:
    """Add load time, physical source file and run date."""
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    source_file = F.col("_metadata.file_path") if source_file is None else source_file
    return df.withColumns(
        {
            "ingestion_timestamp": loaded_at,
            "source_file": source_file,
            "pipeline_run_date": loaded_at.cast("date"),
        }
    )

"""What the operators share: tables, session settings, code for the workers, shared folders."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import tillflow
from tillflow.settings import configure
from tillflow.sources.staging import shared_folder

ARCHIVE = "tillflow-workers.zip"
BATCH_ROWS, BATCH_BYTES = 4096, 32 << 20


def prepared(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> SparkSession:
    """Bounded Arrow batches, and this package on the path of all Python workers."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    if not any(name.endswith(ARCHIVE) for name in spark.sparkContext._python_includes):
        root = Path(tillflow.__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="tillflow-")) / ARCHIVE
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def under_own_names(docs: DataFrame, function: Callable[..., DataFrame], *columns: str) -> DataFrame:
    """``function(docs, *columns)`` with all columns named ``given0``, ``given1`` ..., so that no name it makes clashes.

    function returns rows with these columns; they come back under their names.
    """
    names = {name: f"given{i}" for i, name in enumerate(docs.columns)}
    found = function(docs.toDF(*names.values()), *(names[c] for c in columns))
    return found.select(*names.values()).toDF(*names)


def arrow_map(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``function`` over each Arrow batch; it may yield any number of batches."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(over, schema)

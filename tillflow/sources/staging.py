"""Intermediate results that several plans read."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_paths: ContextVar[list[str] | None] = ContextVar("paths", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session that runs in one process, as in tests, gets a folder of its own if none is named.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillflow-"))
    return spark.sparkContext.getCheckpointDir()


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Consumers share one computation, a lost executor costs a re-read instead of
    a re-run, and file sizes tell the optimizer what may be broadcast.  Folders
    staged within :func:`cleared` go with it; others stay until somebody clears the
    application's folder, as whoever reads the result may do so at any time.
    """
    spark = df.sparkSession
    run = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/{run}/{label}-{uuid.uuid4().hex}"
    if (paths := _paths.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside, once the caller has written its result."""
    paths: list[str] = []
    outer = _paths.set(paths)
    try:
        yield
    finally:
        _paths.reset(outer)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system the path names; none there is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

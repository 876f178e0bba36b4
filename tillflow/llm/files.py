"""Files of the shared folder that tasks write and read beside Spark's tables."""

from __future__ import annotations

import mmap
import shutil
import tempfile
import uuid

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme and authority that it has on this cluster."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def written(folder: str, label: str, values: np.ndarray) -> str:
    """Write an array under a name that no other attempt of the task takes; returns the name."""
    system, path = located(folder)
    system.create_dir(path, recursive=True)
    name = f"{label}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(np.ascontiguousarray(values).data.cast("B") if values.size else b"")
    return name


def mapped(folder: str, name: str, kind: type) -> np.ndarray:
    """The array, mapped into memory.

    A folder that is no local path for this worker is read through a temporary copy, which
    has no name any more and goes when the mapping does.
    """
    system, path = located(f"{folder}/{name}")
    if isinstance(system, fs.LocalFileSystem):
        file = open(path, "rb")  # noqa: SIM115
    else:
        file = tempfile.TemporaryFile()  # noqa: SIM115
        with system.open_input_stream(path) as source:
            shutil.copyfileobj(source, file)
        file.flush()
    with file:
        size = file.seek(0, 2)
        if not size:
            return np.zeros(0, kind)
        # The mapping stays when the file is closed, and takes no file descriptor of its own.
        return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), kind)


def written_together(folder: str, label: str, arrays: list[np.ndarray]) -> str:
    """Write several arrays as one file, each at a multiple of eight bytes; returns its name."""
    data = [np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(data), *map(len, data)], np.int64).tobytes()
    return written(folder, label, np.frombuffer(b"".join([head, *(d + bytes(-len(d) % 8) for d in data)]), np.uint8))


def mapped_together(folder: str, name: str, kinds: tuple[type, ...]) -> tuple[np.ndarray, ...]:
    """The arrays of such a file, mapped into memory at once."""
    data = mapped(folder, name, np.uint8)
    sizes = data[8 : 8 + 8 * len(kinds)].view(np.int64)
    out, at = [], 8 + 8 * len(kinds)
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(data[at : at + size].view(kind))
        at += size + -size % 8
    return tuple(out)

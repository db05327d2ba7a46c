"""Plain files in the shared folder, from tasks and from the driver.

The folder is named by Hadoop (``spark.checkpoint.dir``); tasks reach it
through pyarrow's file systems.  Task output is named by partition and attempt
and becomes visible only through the manifest that Spark commits, so lost or
repeated attempts leave nothing that a reader would take.
"""
from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import SparkSession

from tipscope.session import checkpoint_dir

_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder below the checkpoint folder, made if its store has folders."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    uri = fs.makeQualified(path).toUri()
    scheme, rest = uri.getScheme(), uri.getPath()
    host = uri.getAuthority()
    return f"{_SCHEMES.get(scheme, scheme)}://{host or ''}{rest}"


def open_store(uri: str):
    """File system and path of a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def local_path(uri: str) -> str | None:
    return uri.removeprefix("file://") if uri.startswith("file://") else None


def mapped(uri: str, dtype: str, offset: int = 0, count: int = -1) -> np.ndarray:
    """Array over a part of a flat file: memory-mapped where the file is in a
    mounted file system, read by range elsewhere."""
    size = np.dtype(dtype).itemsize
    path = local_path(uri)
    if path is not None:
        if count == 0:
            return np.empty(0, dtype)
        shape = None if count < 0 else (count,)
        return np.memmap(path, dtype=dtype, mode="r", offset=offset, shape=shape)
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        n = f.size() - offset if count < 0 else count * size
        return np.frombuffer(f.read_at(n, offset), dtype=dtype)

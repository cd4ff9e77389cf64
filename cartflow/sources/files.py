"""File-system helpers: addresses, listings and staged replacement."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Tasks get these functions by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop file system and path object of an address."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written."""
    fs, hpath = hadoop_path(spark, path)
    fs.delete(hpath, True)


def located(address: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of an address, for range reads in tasks; Hadoop writes local
    ones with one slash."""
    if address.startswith("file:/") and not address.startswith("file://"):
        address = "file://" + address[5:]
    return arrow_fs.FileSystem.from_uri(address) if "://" in address else (arrow_fs.LocalFileSystem(), address)


def replace_path(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Put what ``write(folder)`` writes in the place of ``path``.

    It is written beside it first; only when it is whole is the old data moved aside, the
    new moved in, and the old deleted.  A job that fails leaves the old data as it was (if
    it dies between the two moves, under ``<path>.old-...``)."""
    path, mark = path.rstrip("/"), uuid.uuid4().hex
    fresh, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    try:
        write(fresh)
        fs, target = hadoop_path(spark, path)
        held = bool(fs.exists(target))
        if held:
            _move(spark, path, old)
        try:
            _move(spark, fresh, path)
        except Exception:
            if held:
                _move(spark, old, path)
            raise
        if held:
            remove_path(spark, old)
    finally:
        if path_exists(spark, fresh):
            remove_path(spark, fresh)
    return path


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, hsource = hadoop_path(spark, source)
    _, htarget = hadoop_path(spark, target)
    if not fs.rename(hsource, htarget):
        raise OSError(f"{source} cannot be moved to {target}")

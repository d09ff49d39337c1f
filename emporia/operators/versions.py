"""Replacing a folder of files so that readers never see half of it.

A replaced folder holds *version* folders and one pointer file that names the
version in force.  A replacement writes a new version folder and then swaps
the pointer by one rename, the only step that readers notice; a write that
fails, or a driver that is lost before the swap, leaves the table as it was.
A query that has planned its scan keeps reading the version it found, which
stays until the replacement after next.  A folder without a pointer is read as
it is, so plain Parquet folders can be read and, when replaced, turn into
versioned ones.

File access goes through Hadoop's file system of the path, as Spark's own.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "_current"
VERSION = "v-"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for ``path``, and the path for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``, in order (none if it is absent)."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def _read_pointer(spark: SparkSession, path: str) -> str | None:
    fs, where = file_system(spark, f"{path}/{POINTER}")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _swap_pointer(spark: SparkSession, path: str, version: str) -> None:
    """Let ``path`` point to ``version``: written aside, then renamed over the pointer."""
    jvm = spark._jvm
    fs, aside = file_system(spark, f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(aside)
    try:
        stream.write(bytearray(version, "utf-8"))
    finally:
        stream.close()
    options = jvm.org.apache.hadoop.fs.Options
    overwrite = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    overwrite[0] = getattr(options, "Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), overwrite)


def new_version() -> str:
    """A version's name; names sort by time."""
    return f"{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of ``path`` now."""
    version = _read_pointer(spark, path)
    return path if version is None else f"{path}/{version}"


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new version folder, then point ``path`` to it.

    Of the older versions the one that was in force stays for its readers;
    those before it go.
    """
    path = path.rstrip("/")
    before, version = _read_pointer(spark, path), new_version()
    write(f"{path}/{version}")
    _swap_pointer(spark, path, version)
    for name in folders(spark, path):
        if name.startswith(VERSION) and name not in (before, version):
            delete(spark, f"{path}/{name}")

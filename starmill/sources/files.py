"""What exists under a path, asked of the file system Spark itself uses."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The Hadoop path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = located(spark, path)
    return files.exists(target)


def child_directories(spark: SparkSession, path: str, prefix: str | None = None) -> list[str]:
    """Names of the directories directly under a path, sorted; none if the path is absent.

    Without a prefix, hidden ones are left out.
    """
    if not exists(spark, path):
        return []
    target, files = located(spark, path)
    names = [e.getPath().getName() for e in files.listStatus(target) if e.isDirectory()]
    if prefix is None:
        return sorted(name for name in names if not name.startswith(("_", ".")))
    return sorted(name for name in names if name.startswith(prefix))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path; 0 if it is absent."""
    target, files = located(spark, path)
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    target, files = located(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, files = located(spark, path)
    stream = files.create(target)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written, by the clock of its file system and of this machine."""
    target, files = located(spark, path)
    return time.time() - files.getFileStatus(target).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> None:
    target, files = located(spark, path)
    files.delete(target, True)

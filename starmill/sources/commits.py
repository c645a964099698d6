"""Small commit files whose names decide: each is created whole and once, or not at all.

A commit is a text file. It is written under a name nobody else uses and then given its own name by a step that
fails if that name is taken: a hard link in a local folder, a rename without overwriting elsewhere, which
HDFS does atomically. (An object store is as safe as its rename of one small object.) So of several
writers of one name exactly one wins, and no reader sees half a file.
"""

from __future__ import annotations

import os
import uuid
from pathlib import Path
from typing import Any
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from starmill.sources.files import located, read_text, write_text


def _local(files: Any, target: Any) -> str | None:
    """The path in the local file system, if the file system is that."""
    if files.getScheme() != "file":
        return None
    return unquote(urlparse(files.makeQualified(target).toString()).path)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet; False if somebody else has."""
    target, files = located(spark, path)
    if files.exists(target):
        return False
    written = f"{target.getParent().toString()}/.writing-{uuid.uuid4().hex}"
    here = _local(files, target)
    if here is not None:
        os.makedirs(os.path.dirname(here), exist_ok=True)
        aside = Path(os.path.dirname(here), os.path.basename(written))
        aside.write_text(text)
        try:
            os.link(aside, here)
        except FileExistsError:
            return False
        finally:
            aside.unlink()
        return True
    write_text(spark, written, text)
    return rename_once(spark, written, path)


def rename_once(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that must be free; False, and the file is gone, if it is taken."""
    old, files = located(spark, source)
    new, _ = located(spark, target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(old), files.makeQualified(new), none)
    except Py4JJavaError as error:
        files.delete(old, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


class CommitLog:
    """Numbered commits in one folder: the last one counts."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def numbers(self) -> list[int]:
        target, files = located(self.spark, self.folder)
        if not files.exists(target):
            return []
        names = [e.getPath().getName() for e in files.listStatus(target)]
        return sorted(int(name) for name in names if name.isdigit())

    def path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}"

    def last(self) -> tuple[int, str] | None:
        """Number and text of the last commit."""
        numbers = self.numbers()
        if not numbers:
            return None
        return numbers[-1], self.text(numbers[-1])

    def text(self, number: int) -> str:
        return read_text(self.spark, self.path(number))

    def commit_after(self, number: int, text: str) -> bool:
        """Follow the commit of a number (0: none yet); False if another commit already does."""
        return create_once(self.spark, self.path(number + 1), text)

"""Intermediate results written once to the shared folder, and their removal.

Every application has a folder of its own in the shared one. Its paths are removed when the scope ends in which
they were handed out (``scratch_scope``), and the whole folder when the Python process ends. A process that
dies leaves its folder behind; a lease tells that it is dead. The lease is a file that the application
touches while it lives, so ``expire_scratch`` of any other application can remove folders whose lease ran out.
"""

from __future__ import annotations

import atexit
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from starmill.session import _FIRST_USE, application_folder, fresh_path, path_scope, shared_folder
from starmill.sources.files import age_seconds, child_directories, exists, located, remove

LEASE = "_lease"
#: Seconds a lease lasts, and how often it is renewed.
LEASE_SECONDS, RENEWAL_SECONDS = 6 * 3600.0, 1800.0


def written_once(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` from a fresh Parquet table, for results that several jobs read."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes what is staged inside when it ends; results must be consumed or written by then.

    Scopes are of the process: other threads' paths of that time belong to the innermost one, too.
    """
    with path_scope() as paths:
        try:
            yield
        finally:
            for path in paths:
                remove(spark, path)


def expire_scratch(spark: SparkSession, older_than: float = LEASE_SECONDS) -> list[str]:
    """Remove the folders of applications that have not renewed their lease for so many seconds.

    Folders without a lease are somebody else's and stay. Returns the names of the removed ones.
    """
    gone, folder = [], shared_folder(spark)
    for name in child_directories(spark, folder):
        lease = f"{folder}/{name}/{LEASE}"
        mine = name == spark.sparkContext.applicationId
        if not mine and exists(spark, lease) and age_seconds(spark, lease) > older_than:
            remove(spark, f"{folder}/{name}")
            gone.append(name)
    return gone


def _keep_while_alive(spark: SparkSession) -> None:
    """Renew the application's lease until the process ends, and remove its folder then."""
    # The file system outlives the session.
    folder, files = located(spark, application_folder(spark))
    lease, _ = located(spark, f"{application_folder(spark)}/{LEASE}")
    process = getattr(spark.sparkContext._gateway, "proc", None)
    ended = threading.Event()

    def alive() -> bool:
        return process is None or process.poll() is None

    def renew() -> None:
        while alive():
            files.create(lease, True).close()
            if ended.wait(RENEWAL_SECONDS):
                return

    def leave() -> None:
        ended.set()
        if alive():
            files.delete(folder, True)

    files.create(lease, True).close()
    threading.Thread(target=renew, daemon=True).start()
    atexit.register(leave)


_FIRST_USE.append(_keep_while_alive)

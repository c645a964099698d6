"""Session set-up, cluster sizing and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

MIB = 1024 * 1024
CONCURRENT_JOBS = 8

Result = TypeVar("Result")


def sizing(shuffled_bytes: int, cores: int, target_bytes: int = 200 * MIB) -> dict[str, str]:
    """Settings that keep one shuffle partition near ``target_bytes``.

    The initial partition number only has to be large enough: adaptive execution merges small
    partitions and splits skewed ones, but it cannot split an even partition that is too big.
    """
    partitions = max(cores, math.ceil(shuffled_bytes / target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB if partitions > 10_000 else 128 * MIB),
    }


def build_session(
    app_name: str = "starmill", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with UTC time, ANSI errors and adaptive execution; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="starmill-"))
    return context.getCheckpointDir().rstrip("/")


def application_folder(spark: SparkSession) -> str:
    """The part of the shared folder that this application alone writes to."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


#: Paths handed out in each scope that is open, innermost last.
_SCOPES: list[list[str]] = []
#: What is called with the session when an application takes its first path.
_FIRST_USE: list[Callable[[SparkSession], None]] = []
_USED: set[str] = set()
_GUARD = threading.Lock()


def fresh_path(spark: SparkSession, label: str, scoped: bool = True) -> str:
    """A path nobody has used, in the application's folder.

    It belongs to the innermost open scope of ``sources.scratch``, unless it is for the whole application.
    """
    folder = application_folder(spark)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    with _GUARD:
        first = folder not in _USED
        _USED.add(folder)
        if scoped and _SCOPES:
            _SCOPES[-1].append(path)
    if first:
        for begin in _FIRST_USE:
            begin(spark)
    return path


@contextmanager
def path_scope() -> Iterator[list[str]]:
    """The paths that ``fresh_path`` hands out while the scope is open."""
    paths: list[str] = []
    with _GUARD:
        _SCOPES.append(paths)
    try:
        yield paths
    finally:
        with _GUARD:
            _SCOPES.remove(paths)


def side_by_side(jobs: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Independent jobs submitted together, results by name; the first error is raised.

    A small table then need not wait for the fact, and its few tasks fill idle cores.
    """
    inherit = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}

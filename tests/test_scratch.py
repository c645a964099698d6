"""Staged tables go when a scope, a process or a lease ends."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap
import time
from pathlib import Path

import pytest

from starmill.session import application_folder, fresh_path, shared_folder
from starmill.sources.files import exists, write_text
from starmill.sources.scratch import LEASE, expire_scratch, scratch_scope, written_once

ROOT = Path(__file__).resolve().parents[1]


def test_scopes_remove_what_was_staged_inside(spark) -> None:
    outer = written_once(spark.range(3), "outer")
    with scratch_scope(spark):
        middle = fresh_path(spark, "middle")
        spark.range(2).write.parquet(middle)
        kept = fresh_path(spark, "kept", scoped=False)
        spark.range(1).write.parquet(kept)
        with scratch_scope(spark):
            inner = written_once(spark.range(4), "inner").inputFiles()[0]
        assert not exists(spark, os.path.dirname(inner)) and exists(spark, middle)
    assert not exists(spark, middle) and exists(spark, kept) and outer.count() == 3


def test_scope_that_fails_is_cleared_too(spark) -> None:
    with pytest.raises(ValueError), scratch_scope(spark):
        path = fresh_path(spark, "failed")
        spark.range(2).write.parquet(path)
        raise ValueError
    assert not exists(spark, path)


def test_expired_leases(spark) -> None:
    """Folders of dead applications go; those of living ones, our own and foreign ones stay."""
    fresh_path(spark, "mine")
    folder = shared_folder(spark)
    for name in ("app-dead", "app-alive"):
        write_text(spark, f"{folder}/{name}/{LEASE}", "")
        write_text(spark, f"{folder}/{name}/table/part", "x")
    write_text(spark, f"{folder}/foreign/part", "x")
    old = time.time() - 8 * 3600
    for name in ("app-dead", os.path.basename(application_folder(spark))):
        os.utime(f"{folder.removeprefix('file:')}/{name}/{LEASE}", (old, old))
    assert expire_scratch(spark) == ["app-dead"]
    assert exists(spark, f"{folder}/app-alive/table/part") and exists(spark, f"{folder}/foreign/part")
    assert exists(spark, application_folder(spark)) and not exists(spark, f"{folder}/app-dead")


@pytest.mark.parametrize("stop", ["spark.stop()", ""])
def test_nothing_is_left_when_the_process_ends(tmp_path, stop) -> None:
    code = f"""
    from starmill.session import build_session, application_folder
    from starmill.sources.files import exists
    from starmill.sources.scratch import LEASE, written_once
    spark = build_session("leaving", "local[1]", {{"spark.checkpoint.dir": "{tmp_path}/shared", "spark.ui.enabled": "false"}})
    assert written_once(spark.range(3), "staged").count() == 3
    assert exists(spark, f"{{application_folder(spark)}}/{{LEASE}}")
    {stop}
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=ROOT, timeout=120, capture_output=True)
    assert list((tmp_path / "shared").rglob("*.parquet")) == []
    assert not [p for p in (tmp_path / "shared").glob("local-*")]

"""Versioned tables with optimistic commits: any number of writers, readers that never see half a version.

A version is a folder of its own (``<path>/data-<unique>``) and a marker ``<path>/_commits/<n>.json``
that names it. Writing a version can't disturb another: its folder is nobody else's, and it becomes
version n only by creating marker n, which one writer alone can do (``store.publish``). Who comes
second builds on the version that won and tries the next number. Folders of failed or beaten attempts
are never named by a marker and so never read; ``expire`` removes them, and versions that are too old.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from civicmart.sources import store

LOG_SCHEMA = "run int, folder string, committed_at timestamp, last_id int"


@dataclass(frozen=True)
class Version:
    run: int
    folder: str
    last_id: int


class Conflict(RuntimeError):
    """Other writers won every time."""


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def latest(path: str) -> Version | None:
    """The newest committed version."""
    names = [f.base_name for f in store.listed(_commits(path)) if f.base_name.endswith(".json")]
    if not names:
        return None
    marker = json.loads(store.read_text(f"{_commits(path)}/{max(names)}"))
    return Version(marker["run"], marker["folder"], marker["last_id"])


def history(spark: SparkSession, path: str) -> DataFrame:
    """The commit log: run, folder, committed_at, last_id (empty before the first commit)."""
    if latest(path) is None:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).json(f"{_commits(path)}/*.json")


def commit(path: str, build: Callable[[Version | None, str], int], attempts: int = 20) -> Version:
    """Add a version. ``build(base, folder)`` writes what follows ``base`` to ``folder`` and returns the
    last id it gave; it runs again, on the new base, whenever another writer was faster."""
    path = path.rstrip("/")
    for attempt in range(attempts):
        base = latest(path)
        run, folder = (base.run if base else 0) + 1, f"{path}/data-{uuid.uuid4().hex}"
        last_id = build(base, folder)
        marker = {"run": run, "folder": folder.rsplit("/", 1)[1], "last_id": last_id,
                  "committed_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}
        if store.publish(f"{_commits(path)}/{run:010d}.json", json.dumps(marker) + "\n"):
            return Version(run, marker["folder"], last_id)
        store.remove(folder)
        time.sleep(min(2.0, 0.05 * 2 ** attempt))
    raise Conflict(f"no commit to {path} after {attempts} attempts")


def data_path(path: str, version: Version) -> str:
    return f"{path.rstrip('/')}/{version.folder}"


def expire(path: str, keep: int = 1, grace_seconds: float = 24 * 3600) -> list[str]:
    """Remove the data of all but the newest ``keep`` versions, and folders that no marker names.

    Markers stay (they are the log, and numbers must not be given twice). A folder without a marker
    may be an attempt under way: it goes only if it is older than ``grace_seconds``. Returns the names removed.
    """
    path, named, gone = path.rstrip("/"), {}, []
    for f in store.listed(_commits(path)):
        if f.base_name.endswith(".json"):
            marker = json.loads(store.read_text(f"{_commits(path)}/{f.base_name}"))
            named[marker["folder"]] = marker["run"]
    newest = max(named.values(), default=0)
    for f in list(store.listed(path)):
        if f.type != fs.FileType.Directory or not f.base_name.startswith("data-"):
            continue
        old = named.get(f.base_name)
        stale = time.time() - f.mtime.timestamp() > grace_seconds if old is None else old <= newest - keep
        if stale and store.remove(f"{path}/{f.base_name}"):
            gone.append(f.base_name)
    return sorted(gone)

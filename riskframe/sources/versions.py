"""Versioned tables with atomic commit: numbered manifests over immutable snapshots.

A version is a complete snapshot, written under a name of its own, and a manifest ``<number>.json`` that
names it. Publishing a manifest is a compare-and-swap: it is written aside and put in place only if no
manifest of that number exists (a hard link on local disks, a rename on distributed ones, both of
which refuse an existing target). Of two writers that started from the same version exactly one
wins; the other starts again from the new one, or gives up. Readers take the newest manifest and see one
whole snapshot, never part of a write. Meant for small state (ledgers, daily statistics) whose snapshot is
cheap to write again.
"""

import json
import os
import uuid
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_versions"


class CommitConflict(RuntimeError):
    """Another writer has published the version."""


class Version(NamedTuple):
    number: int
    #: Where the snapshot lies, and what the writer recorded with it.
    data: str
    meta: dict


class _Store:
    """The few file operations needed, on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._local = self._fs.getUri().getScheme() == "file"

    def names(self) -> list[str]:
        folder = self._path(f"{self.root}/{MANIFESTS}")
        return [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []

    def text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{MANIFESTS}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Put a complete file in place unless one of that name exists."""
        aside = self._path(f"{self.root}/{MANIFESTS}/_{uuid.uuid4().hex}")
        target = self._path(f"{self.root}/{MANIFESTS}/{name}")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if not self._local:
                return self._fs.rename(aside, target)
            os.link(self._disk(aside), self._disk(target))
            return True
        except FileExistsError:
            return False
        finally:
            self._fs.delete(aside, False)

    def _disk(self, path) -> str:
        return unquote(urlparse(path.toUri().toString()).path)

    def drop(self, data: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{data}"), True)


def latest(spark: SparkSession, root: str) -> Version | None:
    """The newest version, or None before the first commit."""
    store = _Store(spark, root)
    numbers = [int(n[:-5]) for n in store.names() if n.endswith(".json") and not n.startswith(("_", "."))]
    return _version(store, max(numbers)) if numbers else None


def _version(store: _Store, number: int) -> Version:
    found = json.loads(store.text(f"{number:012d}.json"))
    return Version(number, found["data"], found["meta"])


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """The snapshot of a version (the newest by default), or None before the first commit."""
    version = latest(spark, root) if number is None else _version(_Store(spark, root), number)
    return None if version is None else spark.read.parquet(f"{root.rstrip('/')}/{version.data}")


def commit(df: DataFrame, root: str, after: int, meta: dict | None = None) -> Version:
    """Publish ``df`` as version ``after + 1``; raises ``CommitConflict`` if that exists already."""
    store = _Store(df.sparkSession, root)
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{store.root}/{data}")
    text = json.dumps({"version": after + 1, "data": data, "meta": meta or {}})
    if not store.publish(f"{after + 1:012d}.json", text):
        store.drop(data)
        raise CommitConflict(f"version {after + 1} of {root} was written by another run")
    return Version(after + 1, data, meta or {})


def update(
    spark: SparkSession,
    root: str,
    change: Callable[[DataFrame | None, Version | None], DataFrame | None],
    meta: dict | None = None,
    attempts: int = 20,
) -> Version | None:
    """Commit ``change(snapshot, version)``; starts again from the newest version after a conflict.

    A change that returns None leaves the table as it is.
    """
    for _ in range(attempts):
        now = latest(spark, root)
        new = change(None if now is None else read(spark, root, now.number), now)
        if new is None:
            return now
        try:
            return commit(new, root, now.number if now else 0, meta)
        except CommitConflict:
            continue
    raise CommitConflict(f"{root} kept changing over {attempts} attempts")

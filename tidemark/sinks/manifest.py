"""One manifest for all tables of an event store: what is committed, and where it lies.

A manifest is a small JSON file ``<root>/_manifest/v=<N>.json``. It names
every committed folder of every table, so

* a batch is visible in all tables or in none: its folders are written first,
  and one new manifest makes them visible together;
* readers take folders from it and never list the tables' trees;
* a reader keeps its manifest: folders that a newer one no longer names stay
  until :func:`tidemark.sinks.store.vacuum` forgets the old one.

A manifest file is never changed. Version N + 1 is written aside and renamed
to its name, which fails if another writer was there first; the loser reads the
winner's manifest and applies its change to that.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

FOLDER = "_manifest"
_TRIES = 50


@dataclass
class Manifest:
    """Committed folders, relative to the store's root.

    ``batches``: batch id -> table -> ``{"paths", "rows"}``, and ``metrics``.
    ``snapshot``: ``{"through", "state", "files", "index", "vector_keys"}`` of the newest compaction.
    ``merged``: rollup -> ``{"through", "path"}``. ``ledger``: re-drive runs.
    """

    version: int = 0
    generation: int = 0
    batches: dict[int, dict] = field(default_factory=dict)
    snapshot: dict | None = None
    merged: dict[str, dict] = field(default_factory=dict)
    ledger: list[dict] = field(default_factory=list)

    def text(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)

    @staticmethod
    def of(text: str) -> Manifest:
        got = json.loads(text)
        got["batches"] = {int(k): v for k, v in got["batches"].items()}
        return Manifest(**got)

    def paths(self, table: str, after: int | None = None, before: int | None = None) -> list[str]:
        """Folders of a table's batches with ``after < batch < before`` that hold rows."""
        return [
            p
            for b in sorted(self.batches)
            if (after is None or b > after) and (before is None or b < before)
            for p in self.batches[b].get(table, {"rows": 0, "paths": []})["paths"]
            if self.batches[b][table]["rows"]
        ]

    def through(self) -> int | None:
        return self.snapshot["through"] if self.snapshot else None

    def named(self) -> set[str]:
        """Every folder that this manifest names."""
        out = {p for tables in self.batches.values() for t in tables.values() if isinstance(t, dict) for p in t.get("paths", [])}
        for part in [self.snapshot or {}, *self.merged.values(), *self.ledger]:
            named = (part.get(key) for key in ("state", "files", "index", "vector_keys", "path"))
            out |= {p["path"] if isinstance(p, dict) else p for p in named if p}
        return out


class Files:
    """The few file-system calls a commit needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self._path(name)))

    def names(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(name))]

    def modified(self, name: str) -> int:
        """Modification time in milliseconds."""
        return int(self._fs.getFileStatus(self._path(name)).getModificationTime())

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> bool:
        """Atomic where the file system's rename is; False if ``to`` exists."""
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(self._path(name)), self._fs.makeQualified(self._path(to)), none)
        except Exception:
            if self.exists(to):
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def versions(spark: SparkSession, root: str) -> list[int]:
    names = Files(spark, root).names(FOLDER)
    return sorted(int(n[len("v="):-len(".json")]) for n in names if n.startswith("v=") and n.endswith(".json"))


def _name(version: int) -> str:
    return f"{FOLDER}/v={version}.json"


def load(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest manifest (or the given one); an empty one where nothing has been committed."""
    if version is None:
        known = versions(spark, root)
        if not known:
            return Manifest()
        version = known[-1]
    return Manifest.of(Files(spark, root).read(_name(version)))


def commit(spark: SparkSession, root: str, change: Callable[[Manifest], Manifest | None]) -> Manifest:
    """Apply ``change`` to the newest manifest and make the result the newest; None changes nothing.

    ``change`` may be called again, on a newer manifest, when another writer commits first.
    """
    files = Files(spark, root)
    for _ in range(_TRIES):
        current = load(spark, root)
        new = change(copy.deepcopy(current))
        if new is None:
            return current
        new.version = current.version + 1
        aside = f"{FOLDER}/.{uuid.uuid4().hex}"
        files.write(aside, new.text())
        if files.rename(aside, _name(new.version)):
            return new
        files.remove(aside)
    raise RuntimeError(f"no commit in {_TRIES} tries: too many writers on {root}")

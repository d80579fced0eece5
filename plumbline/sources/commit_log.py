"""A commit log over the folders of one table: optimistic concurrency by numbered manifests.

A writer first writes its rows to a folder of its own, then publishes a manifest under the next
number. A number is given once: publishing fails when another writer has taken it, so the loser
sees what was added meanwhile, settles it with its own rows and tries the next number. Readers
take the folders that the manifests up to the last one name. A writer that stops before it
publishes leaves a folder that no manifest names, which nobody reads and ``vacuum`` deletes.

A manifest holds the folders added and removed; every ``SNAPSHOT``-th also holds all live ones,
so a reader opens one listing and fewer than ``SNAPSHOT`` small files.

The file system must refuse to rename a file onto an existing name (as HDFS does); on local and
mounted folders a hard link, which is refused in the same way, takes the place of the rename.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

SNAPSHOT = 16


@dataclass(frozen=True)
class Snapshot:
    """The table as of one manifest; ``version`` is -1 before the first, ``note`` what its writer left."""

    version: int
    folders: tuple[str, ...]
    note: str | None = None


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._names("_log") if n.endswith(".json") and n[0].isdigit())

    def _read(self, version: int) -> dict:
        stream = self._fs.open(self._path(self._file(version)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    @staticmethod
    def _file(version: int) -> str:
        return f"_log/{version:020d}.json"

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The live folders as of ``version`` (the last one, if not given)."""
        known = [v for v in self.versions() if version is None or v <= version]
        if not known:
            return Snapshot(-1, ())
        later, note = [], None
        live: list[str] = []
        for v in reversed(known):
            manifest = self._read(v)
            note = manifest.get("note") if v == known[-1] else note
            if "live" in manifest:
                live = list(manifest["live"])
                break
            later.append(manifest)
        for manifest in reversed(later):
            live = [f for f in live if f not in set(manifest["removed"])] + manifest["added"]
        return Snapshot(known[-1], tuple(live), note)

    def stage(self, mark: str = "") -> str:
        """A fresh folder (relative to the table) to write rows to before they are published; ``mark`` ends its name."""
        return f"data/commit=c{uuid.uuid4().hex}{mark}"

    def location(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def publish(self, base: Snapshot, added: list[str], removed: tuple[str, ...] | list[str] = (), note: str | None = None) -> bool:
        """Make ``added`` visible and ``removed`` invisible; False if ``base`` is not the last snapshot any more.

        ``note`` goes with the snapshot: what a writer has dealt with so far, say.
        """
        version = base.version + 1
        manifest = {"added": list(added), "removed": list(removed), "note": note, "time": time.time()}
        if version % SNAPSHOT == 0:
            manifest["live"] = [f for f in base.folders if f not in set(removed)] + list(added)
        return self._create(self._file(version), json.dumps(manifest))

    def _create(self, name: str, text: str) -> bool:
        """Create a file with its whole content, unless the name is taken."""
        draft = f"_log/.draft-{uuid.uuid4().hex}"
        self._fs.mkdirs(self._path("_log"))
        if self._fs.getUri().getScheme() == "file":
            draft, target = self._local(draft), self._local(name)
            with open(draft, "w", encoding="utf-8") as file:
                file.write(text)
            try:
                os.link(draft, target)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
        return self._rename(draft, name, text)

    def _rename(self, draft: str, name: str, text: str) -> bool:
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self._path(draft), self._path(name), options)
            return True
        except Exception as failed:  # a Java exception comes as a py4j error
            if "FileAlreadyExistsException" not in str(failed):
                raise
            self._fs.delete(self._path(draft), False)
            return False

    def _local(self, name: str) -> str:
        return unquote(urlparse(self._path(name).toUri().toString()).path)

    def expire(self, keep: int = 1) -> None:
        """Forget versions before the last ``keep`` ones, with the folders only they name.

        For a log with one writer. Readers of older snapshots must have finished.
        """
        known = self.versions()[-keep:]
        if not known:
            return
        alive = {f for v in known for f in self.snapshot(v).folders}
        first = self.snapshot(known[0])
        manifest = self._read(known[0])
        if "live" not in manifest:  # what comes before it will not be read any more
            text = json.dumps({**manifest, "live": list(first.folders)})
            stream = self._fs.create(self._path(self._file(known[0])), True)
            stream.write(bytearray(text, "utf-8"))
            stream.close()
        for v in self.versions():
            if v < known[0]:
                self._fs.delete(self._path(self._file(v)), False)
        for name in self._names("data"):
            if f"data/{name}" not in alive:
                self._fs.delete(self._path(f"data/{name}"), True)

    def vacuum(self, older_than_seconds: float) -> list[str]:
        """Delete data folders that no manifest of any version names, once they are that old; returns them."""
        named = set()
        for v in self.versions():
            manifest = self._read(v)
            named |= {*manifest["added"], *manifest.get("live", ())}
        gone = []
        for name in self._names("data"):
            folder = f"data/{name}"
            if folder in named or time.time() - self._fs.getFileStatus(self._path(folder)).getModificationTime() / 1000 < older_than_seconds:
                continue
            self._fs.delete(self._path(folder), True)
            gone.append(folder)
        return gone

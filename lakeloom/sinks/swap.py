"""Replace a folder, or some of its sub-folders, so that a stop at any step loses no row.

The new contents are written to ``_<name>.swap/data`` beside the target. Then a marker is put
there by one rename; it lists the sub-folders to replace and to remove (the empty name stands for
the whole target). Until the marker is there, nothing has happened to the target. From then
on the new contents count, and moving them in is a list of steps that can be run again:
a listed folder that is still in ``data`` has not been moved in yet.

``recover`` is called before a target is read or written. It finishes a swap that has its marker; a
writer also clears away one that has none. One writer at a time is assumed, as for all folder
sinks; a reader may finish a writer's swap for it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession


class Swap:
    def __init__(self, spark: SparkSession, target: str, applied: Callable[[], None] = lambda: None):
        """``applied`` runs once all folders are in place, again if it was interrupted."""
        self._applied = applied
        self._jvm = spark.sparkContext._jvm
        self.target = target.rstrip("/")
        path = self._path(self.target)
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        parent = path.getParent().toString().rstrip("/")
        self.root = f"{parent}/_{path.getName()}.swap"
        self.data, self.marker = f"{self.root}/data", f"{self.root}/commit"

    # -- steps on the file system; every change goes through one of these -------
    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def _delete(self, name: str) -> None:
        if self._exists(name) and not self._fs.delete(self._path(name), True) and self._exists(name):
            raise OSError(f"{name} could not be removed")

    def _rename(self, old: str, new: str) -> None:
        self._fs.mkdirs(self._path(new).getParent())
        if not self._fs.rename(self._path(old), self._path(new)) and self._exists(old):
            raise OSError(f"{old} could not be moved to {new}")

    def _save(self, name: str, text: str) -> None:
        out = self._fs.create(self._path(name), True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def _load(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    # -- the swap ------------------------------------------------------------------
    def folders(self, depth: int) -> list[str]:
        """Sub-folders of the new contents that lie ``depth`` levels deep, as relative names."""
        names = [""]
        for _ in range(depth):
            names = [f"{n}/{s.getPath().getName()}".lstrip("/") for n in names
                     for s in self._fs.listStatus(self._path(f"{self.data}/{n}".rstrip("/")))
                     if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))]
        return names

    def commit(self, replaced: list[str], removed: list[str] = ()) -> None:
        """From here on the new contents count; then they are moved in."""
        self._save(f"{self.marker}.tmp", json.dumps({"replaced": list(replaced), "removed": list(removed)}))
        self._rename(f"{self.marker}.tmp", self.marker)
        self._finish()

    def _finish(self) -> None:
        todo = json.loads(self._load(self.marker))
        for name in todo["replaced"]:
            new, old = (f"{base}/{name}".rstrip("/") for base in (self.data, self.target))
            if self._exists(new):
                self._delete(old)
                self._rename(new, old)
        for name in todo["removed"]:
            self._delete(f"{self.target}/{name}")
        self._applied()
        # The marker goes last but for the empty folder: without it, what is left is cleared away.
        self._delete(self.marker)
        self._delete(self.root)

    def recover(self, writer: bool = False) -> None:
        """Finish a committed swap; a writer also removes an uncommitted one."""
        if self._exists(self.marker):
            self._finish()
        elif writer:
            self._delete(self.root)

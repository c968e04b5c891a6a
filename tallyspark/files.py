"""Small file operations on any file system that Spark knows (through Hadoop's ``FileSystem``), and publication of rewritten
folders: new ones are moved in beside the old, then the old are removed, by a manifest that a later run can finish.

Only names and sizes of files pass through here, never rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

WORK = "_work-"  # folders that Spark's readers pass over


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_dir: bool
    size: int
    modified: int  # milliseconds


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def list(self, path: str) -> list[Entry]:
        """What lies in a folder, by name; nothing if there is no such folder."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        found = [Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)]
        return sorted(found, key=lambda e: e.name)

    def walk(self, path: str) -> list[Entry]:
        """The files below a folder."""
        return [f for e in self.list(path) for f in (self.walk(e.path) if e.is_dir else [e])]

    def stat(self, path: str) -> Entry | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        s = fs.getFileStatus(p)
        return Entry(p.getName(), path, s.isDirectory(), s.getLen(), s.getModificationTime())

    def rename(self, source: str, target: str) -> None:
        """Move a file or folder; its new parent is made, an existing target is an error."""
        fs, s = self._at(source)
        _, t = self._at(target)
        if fs.exists(t):
            raise FileExistsError(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(s, t):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def create(self, path: str, text: str) -> bool:
        """Write a new file; false if there is one of that name already, which no other writer can then overwrite."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        if fs.exists(p):
            return False
        try:
            out = fs.create(p, False)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        out.write(text.encode())
        out.close()
        return True

    def replace(self, path: str, text: str) -> None:
        """Write a file beside its name, then move it there: a reader sees the old text or the new one."""
        parent, name = path.rsplit("/", 1)
        fresh = f"{parent}/_{name}-{uuid.uuid4().hex[:8]}"
        self.create(fresh, text)
        self.delete(path)
        self.rename(fresh, path)

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def work_folder(root: str) -> str:
    """A fresh folder for rewritten parts of the table below ``root``."""
    return f"{root.rstrip('/')}/{WORK}{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, work: str, moves: list[tuple[str, str]], replaced: list[str]) -> None:
    """Move folders of ``work`` to their places, then remove those that they replace.

    The list of both is written first, so ``finish_publications`` can go on after a crash anywhere.  Until the end a reader
    sees old and new rows, and never fewer than there were."""
    Files(spark).create(f"{work}/manifest.json", json.dumps({"moves": moves, "replaced": replaced}))
    _finish(Files(spark), work)


def _finish(files: Files, work: str) -> None:
    plan = json.loads(files.read(f"{work}/manifest.json"))
    for source, target in plan["moves"]:
        if files.exists(source):
            files.rename(source, target)
    for path in plan["replaced"]:
        files.delete(path)
    files.delete(work)


def finish_publications(spark: SparkSession, root: str) -> int:
    """Finish what a broken-off run had begun to publish below ``root`` and remove what it had not; the number of such runs.  A
    table is rewritten by one run at a time."""
    files = Files(spark)
    found = [e for e in files.list(root) if e.is_dir and e.name.startswith(WORK)]
    for e in found:
        if files.exists(f"{e.path}/manifest.json"):
            _finish(files, e.path)
        else:
            files.delete(e.path)
    return len(found)

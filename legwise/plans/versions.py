"""A set of tables that changes as one.

Every refresh writes its tables below ``_versions/<id>``; the file ``_current``
names the version that readers see. Putting a new pointer in its place is one
atomic rename, and it is the commit: before it every reader gets the whole old
version, after it the whole new one, whatever dies in between. Versions that are
no longer named stay for ``keep`` further refreshes, for readers that resolved
them, and are then removed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

POINTER = "_current"
VERSIONS = "_versions"
KEEP = 1


class VersionedTables:
    def __init__(self, spark: SparkSession, base_path: str):
        self.spark, self.base = spark, base_path.rstrip("/")
        sc = spark.sparkContext
        self._jvm, self._conf = sc._jvm, sc._jsc.hadoopConfiguration()
        self._root = self._path(self.base)
        self._fs = self._root.getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _read(self) -> dict | None:
        pointer = self._path(f"{self.base}/{POINTER}")
        if not self._fs.exists(pointer):
            return None
        stream = self._fs.open(pointer)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> str | None:
        """Id of the version that readers see."""
        found = self._read()
        return found["version"] if found else None

    def begin(self) -> str:
        """Id of a version to write; nobody sees it until it is committed."""
        return uuid.uuid4().hex[:12]

    def folder(self, version: str) -> str:
        return f"{self.base}/{VERSIONS}/{version}"

    def path(self, table: str, version: str | None = None) -> str:
        """Where a table of the current (or a given) version is."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"no refresh has been committed below {self.base}")
        return f"{self.folder(version)}/{table}"

    def exists(self, table: str) -> bool:
        version = self.current()
        return version is not None and self._fs.exists(self._path(self.path(table, version)))

    def commit(self, version: str, tables: list[str], keep: int = KEEP) -> None:
        """Make ``version`` the one that readers see. Every table must be
        complete."""
        for t in tables:
            if not self._fs.exists(self._path(f"{self.path(t, version)}/_SUCCESS")):
                raise FileNotFoundError(f"table {t} of version {version} is not complete")
        old = self._read()
        past = ([old["version"], *old["past"]] if old else [])[:keep]
        self._swap(json.dumps({"version": version, "tables": sorted(tables), "past": past}))
        self._clean({version, *past})

    def _swap(self, text: str) -> None:
        draft = self._path(f"{self.base}/{POINTER}-{uuid.uuid4().hex[:12]}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._root.toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._path(f"{self.base}/{POINTER}")), options)

    def _clean(self, named: set[str]) -> None:
        """Remove versions that the pointer no longer names, and drafts of
        pointers."""
        folder = self._path(f"{self.base}/{VERSIONS}")
        for status in self._fs.listStatus(folder):
            if status.getPath().getName() not in named:
                self._fs.delete(status.getPath(), True)
        for status in self._fs.listStatus(self._root):
            if status.getPath().getName().startswith(f"{POINTER}-"):
                self._fs.delete(status.getPath(), False)

"""Named versions of a folder's content: a reader sees one of them whole, whatever a writer is doing.

A version is a small JSON file whose name counts up. It is written under another name and renamed when it is complete, so
the newest name is always whole; a second writer of the same version fails. The folders that a version names are written
before it and deleted only after a later version has stopped naming them for ``KEPT`` versions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

# Versions that stay readable after a newer one.
KEPT = 2


class Manifest:
    def __init__(self, root: str):
        self.root = root

    def _folder(self, spark: SparkSession, name: str = "_versions"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def versions(self, spark: SparkSession) -> list[int]:
        fs, folder = self._folder(spark)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, spark: SparkSession, version: int | None = None) -> tuple[int, dict | None]:
        """Number and content of a version, by default the newest; 0 and None where there is none."""
        known = self.versions(spark)
        if not known:
            return 0, None
        chosen = known[-1] if version is None else version
        fs, path = self._folder(spark, f"_versions/{chosen:012d}.json")
        stream = fs.open(path)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return chosen, json.loads(text)

    def commit(self, spark: SparkSession, version: int, content: dict) -> None:
        """Make ``content`` the newest version. Folders to be deleted are listed in it under ``dropped``, by version."""
        fs, path = self._folder(spark, f"_versions/{version:012d}.json")
        _, draft = self._folder(spark, f"_versions/.draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if fs.exists(path) or not fs.rename(draft, path):
            fs.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.root} has another writer")
        for old in self.versions(spark):
            if old <= version - KEPT:
                fs.delete(self._folder(spark, f"_versions/{old:012d}.json")[1], False)

    def delete(self, spark: SparkSession, name: str) -> None:
        fs, path = self._folder(spark, name)
        fs.delete(path, True)

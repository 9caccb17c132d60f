"""Small files and folders through Hadoop's file system interface, so any store that Spark reaches will do."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Files:
    """What a folder of manifests needs: list, read, write once, remove."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self._fs = self._path(self.folder).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, below: str = "") -> list[str]:
        """Names in the folder (or one below it), sorted; none if it does not exist."""
        path = self._path(f"{self.folder}/{below}".rstrip("/"))
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def read_json(self, name: str) -> dict:
        stream = self._fs.open(self._path(f"{self.folder}/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_json_once(self, name: str, value: dict) -> bool:
        """Write the file as a whole; False if another writer has written it before.

        The text goes to a file of its own first and is then renamed without overwriting, as Spark does
        with the metadata of streams, so a reader never sees a part of it.
        """
        target, draft = self._path(f"{self.folder}/{name}"), self._path(f"{self.folder}/.{name}.{self._unique()}")
        if self._fs.exists(target):
            return False
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(draft, target, options)
        except Exception:
            self._fs.delete(draft, False)
            if self._fs.exists(target):
                return False
            raise
        return True

    def _unique(self) -> str:
        return self._jvm.java.util.UUID.randomUUID().toString()

    def remove(self, name: str = "") -> None:
        """Remove a file or folder; one that does not exist is no error."""
        self._fs.delete(self._path(f"{self.folder}/{name}".rstrip("/")), True)

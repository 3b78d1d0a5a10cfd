"""The few file operations that table logs need, through Hadoop's file systems (any shared store works)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Operations on paths below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._sc = spark.sparkContext
        self._fs_package = self._sc._jvm.org.apache.hadoop.fs
        self._conf = self._sc._jsc.hadoopConfiguration()
        self._fs = self.path().getFileSystem(self._conf)

    def path(self, *parts: str):
        return self._fs_package.Path("/".join([self.root, *parts]))

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self.path(*parts))

    def names(self, *parts: str, folders: bool | None = None) -> list[str]:
        """Names in a folder, ascending (none if it does not exist); only folders or only files if said."""
        if not self.exists(*parts):
            return []
        return sorted(st.getPath().getName() for st in self._fs.listStatus(self.path(*parts))
                      if folders is None or st.isDirectory() == folders)

    def size(self, *parts: str) -> int:
        return self._fs.getContentSummary(self.path(*parts)).getLength()

    def mkdirs(self, *parts: str) -> None:
        self._fs.mkdirs(self.path(*parts))

    def move(self, source: tuple[str, ...], target: tuple[str, ...]) -> None:
        """Rename one file; fails if the target exists."""
        kind = getattr(self._fs_package, "Options$Rename")
        context = self._fs_package.FileContext.getFileContext(self.path().toUri(), self._conf)
        context.rename(self.path(*source), self.path(*target), self._sc._gateway.new_array(kind, 0))

    def delete(self, *parts: str) -> None:
        self._fs.delete(self.path(*parts), True)

    def read_text(self, *parts: str) -> str:
        stream = self._fs.open(self.path(*parts))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, text: str, *parts: str) -> None:
        """A file with ``text`` that appears at once with all its content; fails if it exists."""
        *folder, name = parts
        hidden = (*folder, f".{name}.{uuid.uuid4().hex[:8]}")
        self.mkdirs(*folder)
        stream = self._fs.create(self.path(*hidden), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self.move(hidden, parts)
        except Exception:
            self.delete(*hidden)
            raise

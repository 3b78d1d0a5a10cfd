"""A stored, growing log as a stream with offsets of its own (A7, I10): data source ``shoplens_log``.

The log is a folder of text files that are only appended to, as a collector or a mirror of a topic leaves them. An
offset says, per file, how many bytes are read; it is what the query's checkpoint keeps, so a restart goes on where the
last batch ended, in the middle of a file too. Options:

  path              the folder: a path that the driver and all executors can open
  startingOffsets   for a first start: ``earliest`` (default), ``latest``, or JSON ``{"file name": bytes}``, files
                    that it does not name being read from their beginning
  rangeBytes        bytes that one task reads at most (default 64 MB)

Only whole lines are taken: what follows the last line break of a file waits. A task reads a range of bytes and
gives out the lines that begin in it, whichever range they end in, so ranges may be cut anywhere. Each line comes with its file and
place. A file that is shorter than its offset was replaced, which is an error, not a silent reread.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME, SCHEMA = "shoplens_log", "value string, file string, place long"
_BLOCK = 1 << 20

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed package


class Range(InputPartition):
    def __init__(self, file: str, begin: int, end: int):
        super().__init__((file, begin, end))
        self.file, self.begin, self.end = file, begin, end


class LogReader(DataSourceStreamReader):
    def __init__(self, options):
        path = options.get("path")
        if not path:
            raise ValueError("the log needs a path")
        self.folder = path[len("file:"):] if path.startswith("file:") else path
        self.starting = options.get("startingOffsets", "earliest")
        self.range_bytes = int(options.get("rangeBytes", 64 << 20))

    def _whole(self, name: str) -> int:
        """Bytes up to and with the last line break."""
        with open(os.path.join(self.folder, name), "rb") as f:
            at = f.seek(0, os.SEEK_END)
            while at > 0:
                begin = max(0, at - _BLOCK)
                f.seek(begin)
                found = f.read(at - begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                at = begin
        return 0

    def latestOffset(self) -> dict:
        names = sorted(n for n in os.listdir(self.folder) if not n.startswith(("_", ".")))
        return {n: self._whole(n) for n in names if os.path.isfile(os.path.join(self.folder, n))}

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            return {}
        if self.starting == "latest":
            return self.latestOffset()
        return {str(n): int(at) for n, at in json.loads(self.starting).items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for name, until in sorted(end.items()):
            begin = start.get(name, 0)
            if begin > until:
                raise ValueError(f"{name} has {until} bytes, but {begin} are read already: it was replaced")
            out += [Range(name, b, min(b + self.range_bytes, until)) for b in range(begin, until, self.range_bytes)]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        with open(os.path.join(self.folder, partition.file), "rb") as f:
            place = partition.begin
            if place > 0:  # a line that began before belongs to the range before
                f.seek(place - 1)
                place = place - 1 + len(f.readline())
            while place < partition.end:
                line = f.readline()
                if not line:
                    break
                yield line.rstrip(b"\r\n").decode("utf-8", "replace"), partition.file, place
                place += len(line)

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint holds the offsets."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def read_log_feed(spark: SparkSession, path: str, starting: str | dict = "earliest", range_bytes: int | None = None) -> DataFrame:
    """Streaming lines (value, file, place) of the log in ``path``."""
    spark.dataSource.register(LogSource)
    options = {"path": path, "startingOffsets": json.dumps(starting) if isinstance(starting, dict) else starting}
    if range_bytes:
        options["rangeBytes"] = str(int(range_bytes))
    return spark.readStream.format(NAME).options(**options).load()

"""Keyed, replay-safe result tables for micro-batch output (A11-A15), kept as a log of small segments.

Applying a batch writes the batch, and nothing else: its rows, one per key and put together by partition, become one *segment*
(``data/seq=<batch_id>/try=<random>/[date=.../]part-*``). A *manifest* (``_log/<number>.json``) lists the live
segments; it appears at once by a rename that never replaces a file, and only then does the batch count. So

* the cost of a batch follows the batch, not the table or its day: nothing stored is read or rewritten;
* a crash before the manifest leaves files that no reader takes; the replay writes its own;
* a replay after the manifest finds its batch id applied and does nothing, whatever the mode;
* readers plan against one manifest and keep its files while newer ones are written.

What a key's rows in several segments mean is settled when the table is read, by the mode:

  replace        the newest segment's row of a key counts
  add            the value columns of all segments are summed by key
  replace_group  a group's rows in the newest segment that holds the group count, all older ones are gone
  insert_absent  the oldest segment's row of a key counts

A partition (``partition_cols``, e.g. the day) that is in one segment only is read as it is, without a shuffle.
``lookup`` restricts the segments to the asked keys before it settles them, so a batch's point lookups (A15) are one
semi join over the segments of its own days.

Compaction keeps the number of segments small: ``compact_every`` neighbouring segments of a level are merged into one
of the next level, so a row is rewritten once a level; partitions that the last ``compact_every`` batches did not touch
(closed days) are merged into one segment. It runs after a commit, or with ``background=True`` in a thread of its own while
batches go on: a merge reads segments that never change, and its manifest only swaps them. One process writes a table.
Files that the last ``READERS_KEEP`` manifests do not name are deleted.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.sinks.files import Files

MODES = ("replace", "add", "replace_group", "insert_absent")
#: Manifests whose files stay for readers that planned against them.
READERS_KEEP = 10

_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)
_WRITING: set[str] = set()  # folders of segments that no manifest names yet


class KeyedSink:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 mode: str, group_keys: Sequence[str] = (), value_cols: Sequence[str] = (),
                 partition_cols: Sequence[str] = (), compact_every: int = 20, retain: bool = True,
                 background: bool = False):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if mode == "replace_group" and not group_keys:
            raise ValueError("replace_group needs group_keys")
        scope = list(group_keys) if mode == "replace_group" else list(keys)
        if not set(partition_cols) <= set(scope):
            raise ValueError("partition columns must be part of the keys (groups for replace_group)")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.mode = list(keys), mode
        self.group_keys = list(group_keys)
        self.value_cols = list(value_cols) or [f.name for f in schema.fields if f.name not in keys]
        self.partition_cols = list(partition_cols)
        self.compact_every = max(2, int(compact_every))
        self.retain = retain
        self.files = Files(spark, self.path)
        self._lock = _LOCKS[self.path]
        self._pool = ThreadPoolExecutor(1) if background else None
        self._merging: Future | None = None

    # ---- the log ----
    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names("_log", folders=False) if n.endswith(".json") and not n.startswith(".")]

    def _manifest(self, number: int) -> dict:
        return json.loads(self.files.read_text("_log", f"{number:020d}.json"))

    def manifest(self) -> dict | None:
        """The newest manifest: number, batch (the last applied), parts (partitions it wrote), mode, segments."""
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else None

    def versions(self) -> list[int]:
        """Applied batch ids of the manifests that are kept, ascending."""
        return sorted({self._manifest(n)["batch"] for n in self._numbers()})

    def _commit(self, batch: int, segments: list[dict], before: dict | None, parts: list[str]) -> None:
        number = before["number"] + 1 if before else 0
        said = {"number": number, "batch": batch, "parts": parts, "mode": self.mode, "segments": segments}
        self.files.create(json.dumps(said), "_log", f"{number:020d}.json")
        self._expire()

    def _expire(self) -> None:
        """Delete manifests before the last ``READERS_KEEP``, and segments that only those name (or none, after a crash)."""
        if not self.retain:
            return
        numbers = self._numbers()
        kept = [self._manifest(n) for n in numbers[-READERS_KEEP:]]
        named = {s["dir"] for m in kept for s in m["segments"]} | _WRITING
        for n in numbers[:-READERS_KEEP]:
            self.files.delete("_log", f"{n:020d}.json")
        last = kept[-1]["batch"]
        for seq in self.files.names("data", folders=True):
            if int(seq[4:]) <= last:
                tries = self.files.names("data", seq, folders=True)
                gone = [t for t in tries if f"{seq}/{t}" not in named]
                for t in gone:
                    self.files.delete("data", seq, t)
                if len(gone) == len(tries):
                    self.files.delete("data", seq)

    # ---- writing ----
    def _delta(self, batch: DataFrame) -> DataFrame:
        """The batch with one row per key."""
        cols = self.schema.fieldNames()
        if self.mode == "add":
            sums = [F.sum(c).cast(self.schema[c].dataType).alias(c) for c in self.value_cols]
            return batch.groupBy(*self.keys).agg(*sums).select(*cols)
        if self.mode == "replace_group":
            return batch.select(*cols)
        return batch.select(*cols).dropDuplicates(self.keys)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows put together by partition, so that a segment's files follow its partitions and bytes, whatever the number of
        tasks before: adaptive execution joins small partitions and cuts large ones. Stateful streams run without it, there
        a partition of a batch is one file."""
        if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            return rows.hint("rebalance", *self.partition_cols)
        return rows.repartition(*(self.partition_cols or self.keys))

    def _write(self, rows: DataFrame, seq: int, level: int) -> dict:
        folder = f"seq={seq}/try={uuid.uuid4().hex[:12]}"
        _WRITING.add(folder)
        rows = self._dealt(rows)
        writer = rows.write.partitionBy(*self.partition_cols) if self.partition_cols else rows.write
        writer.parquet(f"{self.path}/data/{folder}")
        parts = [""]
        for _ in self.partition_cols:
            parts = [f"{p}/{n}".lstrip("/") for p in parts for n in self.files.names("data", folder, *filter(None, [p]), folders=True)
                     if not n.startswith(("_", "."))]
        return {"dir": folder, "seq": seq, "level": level, "parts": parts, "bytes": self.files.size("data", folder)}

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Append ``batch`` as version ``batch_id``; does nothing if that or a later batch is applied already."""
        if self._merging is not None and self._merging.done():
            self._merging.result()  # a failed merge is told here
        now = self.manifest()
        if now and now["mode"] != self.mode:
            raise ValueError(f"{self.path} is kept in mode {now['mode']}, not {self.mode}")
        if now and batch_id <= now["batch"]:
            return
        segment = self._write(self._delta(batch), batch_id, 0)
        with self._lock:
            now = self.manifest()
            self._commit(batch_id, (now["segments"] if now else []) + ([segment] if segment["parts"] else []), now, segment["parts"])
            _WRITING.discard(segment["dir"])
        if self._pool is None:
            self._tidy()
        elif self._merging is None or self._merging.done():
            self._merging = self._pool.submit(self._tidy)

    # ---- compaction ----
    def _tidy(self) -> None:
        while True:
            segments = self.manifest()["segments"]
            levels = Counter(s["level"] for s in segments)
            full = min((v for v, n in levels.items() if n >= self.compact_every), default=None)
            if full is None:
                break
            run = [s for s in segments if s["level"] == full]
            self._merge(run, None, full + 1)
            if self.partition_cols:
                self.compact_closed()

    def compact_closed(self) -> None:
        """Merge every partition that is in several segments but not in those of the last ``compact_every`` batches."""
        segments = self.manifest()["segments"]
        recent = sorted({s["seq"] for s in segments})[-self.compact_every:]
        open_parts = {p for s in segments if s["level"] == 0 and s["seq"] in recent for p in s["parts"]}
        times = Counter(p for s in segments for p in s["parts"])
        closed = {p for p, n in times.items() if n > 1 and p not in open_parts}
        if closed:
            self._merge([s for s in segments if closed & set(s["parts"])], closed, max(s["level"] for s in segments))

    def _merge(self, run: list[dict], parts: set[str] | None, level: int) -> None:
        """Replace the segments ``run`` (or only their ``parts``) by one."""
        merged = self._write(self._settled(self._rows(run, parts)), max(s["seq"] for s in run), level)
        gone = {s["dir"] for s in run}
        with self._lock:
            now = self.manifest()
            left, at = [], 0
            for s in now["segments"]:
                if s["dir"] in gone:
                    at = len(left)
                    rest = [p for p in s["parts"] if parts is not None and p not in parts]
                    left += [{**s, "parts": rest}] if rest else []
                else:
                    left.append(s)
            left.insert(at, merged)
            self._commit(now["batch"], left, now, now["parts"])
            _WRITING.discard(merged["dir"])

    def wait(self) -> None:
        """Wait for a merge in the background, and raise what it raised."""
        if self._merging is not None:
            self._merging.result()

    # ---- reading ----
    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _rows(self, segments: Iterable[dict], parts: set[str] | None) -> DataFrame | None:
        """The segments' rows (in ``parts``) with their seq."""
        leaves = ["/".join(filter(None, [self.path, "data", s["dir"], p])) for s in segments for p in s["parts"]
                  if parts is None or p in parts]
        if not leaves:
            return None
        schema = T.StructType([*self.schema.fields, T.StructField("seq", T.LongType()), T.StructField("try", T.StringType())])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*leaves)
        return rows.select(*self.schema.fieldNames(), F.col("seq").alias("_seq"))

    def _settled(self, rows: DataFrame) -> DataFrame:
        """One row per key (all of the newest rows per group) of rows from several segments."""
        cols = self.schema.fieldNames()
        if self.mode == "add":
            return rows.groupBy(*self.keys).agg(*[F.sum(c).cast(self.schema[c].dataType).alias(c) for c in self.value_cols]).select(*cols)
        if self.mode == "replace_group":
            last = rows.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(self.group_keys)]).agg(F.max("_seq").alias("_last"))
            same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(self.group_keys)]
            return rows.join(last, reduce(and_, same, F.col("_seq") == F.col("_last"))).select(*cols)
        others = [c for c in cols if c not in self.keys]
        if not others:
            return rows.select(*cols).distinct()
        pick = F.max_by if self.mode == "replace" else F.min_by
        return rows.groupBy(*self.keys).agg(pick(F.struct(*others), F.col("_seq")).alias("_v")).select(
            *[F.col(f"_v.{c}").alias(c) if c in others else F.col(c) for c in cols])

    def _read(self, manifest: dict | None, parts: set[str] | None = None, keys: DataFrame | None = None) -> DataFrame:
        if manifest is None:
            return self._empty()
        segments = manifest["segments"]
        times = Counter(p for s in segments for p in s["parts"] if parts is None or p in parts)
        once, often = {p for p, n in times.items() if n == 1}, {p for p, n in times.items() if n > 1}
        out = None
        for which, settle in ((once, False), (often, True)):
            rows = self._rows(segments, which)
            if rows is None:
                continue
            rows = rows if keys is None else self._matching(rows, keys)
            rows = self._settled(rows) if settle else rows.select(*self.schema.fieldNames())
            out = rows if out is None else out.unionByName(rows)
        return self._empty() if out is None else out

    @staticmethod
    def _matching(rows: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows whose key columns occur in ``keys`` (null equals null)."""
        there = keys.select(*[F.col(c).alias(f"_k_{c}") for c in keys.columns])
        return rows.join(there, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys.columns]), "left_semi")

    def snapshot(self) -> DataFrame:
        """The newest committed table (empty with the sink's schema before the first batch)."""
        return self._as_kept(self.manifest())

    def read_version(self, version: int | None) -> DataFrame:
        """The table as of batch ``version``, if its manifest is still kept (an empty table for ``None``)."""
        if version is None:
            return self._empty()
        kept = [m for m in map(self._manifest, self._numbers()) if m["batch"] <= version]
        return self._as_kept(kept[-1] if kept else None)

    def _as_kept(self, manifest: dict | None) -> DataFrame:
        if manifest and manifest["mode"] != self.mode:  # the other form of the same table
            return KeyedSink(self.spark, self.path, self.schema, self.keys, manifest["mode"], self.group_keys,
                             self.value_cols, self.partition_cols, self.compact_every, self.retain)._read(manifest)
        return self._read(manifest)

    def parts_of(self, batch_id: int) -> set[str] | None:
        """Partitions that batch ``batch_id`` wrote, if it is the last one (None: not known, all of them)."""
        now = self.manifest()
        return set(now["parts"]) if now and now["batch"] == batch_id else None

    def lookup(self, keys: DataFrame, parts: set[str] | None = None) -> DataFrame:
        """The newest table's rows whose columns named like those of ``keys`` (keys or group keys) occur in it."""
        return self._read(self.manifest(), parts, keys)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.runtime import session_conf, shared_dir
from shoplens.sinks.files import Files

#: ASCII white space (space, tab to carriage return) and the words between it.
WS_CHARS = " \t\n\x0b\x0c\r"
WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: What a task holds of long rows at once, at most: bytes of a batch for Python, rows of a batch from Parquet, bytes of a
#: Parquet row group, which is written and read whole.
NARROW = {"spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20, "spark.sql.parquet.columnarReaderBatchSize": 512,
          "parquet.block.size": 4 << 20}
#: A table is broadcast by hint only up to this many (narrow) rows; larger ones are joined plainly.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def words(text: Column) -> Column:
    """Array of the words of ``text``; null text gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS + "+"), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


#: Paths of the tables stored in each open ``scratch`` block, outermost first.
_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("_BLOCKS", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes in the block are removed when it ends; what is used later is stored with ``keep``."""
    mine: list[str] = []
    token = _BLOCKS.set((*_BLOCKS.get(), mine))
    try:
        yield
    finally:
        _BLOCKS.reset(token)
        for path in mine:
            Files(spark, path).delete()


def stored(df: DataFrame, keep: bool = False) -> DataFrame:
    """Narrow intermediate written as Parquet to the shared checkpoint folder, so that later jobs neither
    recompute it nor depend on the executors that made it; its size is known to the joins that follow. In a ``scratch``
    block it goes with the block, or with the one around it if ``keep``."""
    path = shared_dir(df.sparkSession, "stored")
    blocks = _BLOCKS.get()[:-1] if keep else _BLOCKS.get()
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def narrow(spark: SparkSession) -> Iterator[None]:
    """Jobs that run in the block hold few long rows at once (``NARROW``, or less if the session has less); the settings
    are put back when it ends."""
    def less(key: str, most: int) -> str:
        old = spark.conf.get(key, None)
        return old if old and old.isdigit() and 0 < int(old) < most else str(most)

    with session_conf(spark, {k: less(k, v) for k, v in NARROW.items()}):
        yield


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already stored) with a broadcast hint if it is counted to be small, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def in_ranges(rows: DataFrame, order: list[str], ranges: int, sampled: int = 32, seed: int = 42) -> DataFrame:
    """``rows`` (stored) with ``_range`` (0, 1, ..., ascending in ``order``), range r in task r by one shuffle. The borders come
    from a seeded sample, which decides how even the ranges are and nothing else; rows equal in ``order`` are told
    apart by a row number, so no value is too frequent to be split."""
    at = F.struct(*order, "_tie")
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    sample = tied.select(at.alias("k")).sample(min(1.0, sampled * ranges / max(1, rows.count())), seed)
    n = F.size("s")
    # at most ``ranges`` borders, sorted: every n / ranges-th of the sample
    borders = sample.agg(F.sort_array(F.collect_list("k")).alias("s")).select(F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(ranges)), 1, F.when(n > 0, F.lit(ranges - 1)).otherwise(F.lit(0))),
        lambda i: F.get("s", F.floor(i * n / ranges).cast("int")))).scalar()
    tied = tied.withColumn("_borders", borders)

    def halve(x: Column, _: Column) -> Column:
        middle = F.floor((x["lo"] + x["hi"]) / 2).cast("int")
        above = at >= F.get("_borders", middle)
        return F.when(x["lo"] >= x["hi"], x).otherwise(F.struct(
            F.when(above, middle + 1).otherwise(x["lo"]).alias("lo"), F.when(above, x["hi"]).otherwise(middle).alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.coalesce(F.size("_borders"), F.lit(0)).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(ranges.bit_length())), start, halve)
    return tied.withColumn("_range", found["lo"]).drop("_tie", "_borders").repartitionById(ranges, F.col("_range"))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WS = np.zeros(256, dtype=bool)
_IS_WS[[32, 9, 10, 11, 12, 13]] = True
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BLOCK = 1 << 16


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_P, _PINV)):
            full = np.full(max(n, 1 << 20), base, np.uint64)
            full[0] = 1
            _POWERS[k] = np.cumprod(full, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tokens:
    """Words of some consecutive rows: 64-bit hash of each word with A-Z lower-cased, row number,
    byte span. Long rows cost about 3 bytes a byte of text and 40 bytes a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = ~_IS_WS[data]
        first = inside.copy()
        last = inside.copy()
        if n:
            edge = offsets[(offsets > 0) & (offsets < n)]
            cut = inside[1:] & inside[:-1]
            cut[edge - 1] = False
            first[1:] &= ~cut
            last[:-1] &= ~cut
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.hash = np.empty(len(self.start), np.uint64)
        for i in range(0, len(self.start), _BLOCK):
            s, e = self.start[i:i + _BLOCK], self.end[i:i + _BLOCK]
            part = _LOWER[data[s[0]:e[-1]]].astype(np.uint64) + np.uint64(1)
            p, inv = _powers(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * p[:len(part)], dtype=np.uint64, out=sums[1:])
            a, b = s - s[0], e - s[0]
            self.hash[i:i + _BLOCK] = mix64((sums[b] - sums[a]) * inv[a] + (b - a).astype(np.uint64))


def chunks(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[tuple[int, int, Tokens]]:
    """(first row, row after the last, their Tokens) for runs of rows of about ``limit`` bytes."""
    col = batch.column(column).cast(pa.large_string())
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(col):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b, Tokens(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        a = b

"""Structured Streaming jobs for the advertisement click log.

Four queries, each with its own checkpoint under a shared root:

clean      source lines -> ``foreachBatch``: parse (bad lines to ``quarantine/``), re-read the
           current blacklist snapshot, anti-join it, and write the clean clicks to a staging folder. When that
           write is committed, its files are moved to ``clean/batch_id=<id>`` one by one. A replay of a batch whose
           staging is committed only moves what is left, so readers get each file once and none that is half written.
           A batch is cut by time into files of ``CLEAN_FILE_LINES`` lines, whatever the number of tasks.
stat       clean clicks -> ``foreachBatch``: the batch's counts by (date, province, city, adid) are added to
           ``ad_stat``, those by province to ``ad_province_count``. Counts only grow, so the new leaders of a
           (date, province) are among the old ones and the ads that the batch touched: only these are ranked and
           ``replace_group``-ed into ``ad_province_top3``. No state store, nothing is late, no day is read again.
trend      clean clicks -> the batch's counts by minute and ad, added to ``ad_click_trend``.
blacklist  clean clicks -> per batch (date, userid, adid) counts -> keyed ``add`` into
           ``ad_user_click_count``; users whose accumulated count of a touched key exceeds the
           threshold -> keyed ``insert_absent`` into ``ad_blacklist``, which ``clean`` re-reads
           at its next batch.

With a watermark, stat and trend are stateful aggregations in update mode instead (``groupBy(window, ...).count()``,
keyed ``replace``): clicks later than the watermark are dropped and finished days leave the state.
Ranking and aggregating over an aggregation are not allowed inside a streaming plan, so they run
in ``foreachBatch`` over the keyed tables -- set-based, with no per-row lookups.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens.operators import ads
from shoplens.runtime import session_conf
from shoplens.schema import (AD_BLACKLIST, AD_CLICK, AD_CLICK_TREND, AD_PROVINCE_TOP3, AD_STAT,
                             AD_USER_CLICK_COUNT)
from shoplens.sinks.files import Files
from shoplens.sinks.keyed import KeyedSink
from shoplens.sources.adlog import parse_ad_log, quarantine

# None: no click is ever late and nothing is kept in a state store; a watermark drops late clicks.
DEFAULT_WATERMARK = None
DEFAULT_TRIGGER = {"processingTime": "5 seconds"}
#: Log lines of a batch per file of clean clicks: a reader that takes a number of files at a time gets batches of a size that does
#: not depend on how many tasks wrote them.
CLEAN_FILE_LINES = 2_000_000


@dataclass
class AdStreamStore:
    """Folder layout and keyed sinks of one deployment of the ad-click jobs."""

    spark: SparkSession
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def checkpoint(self, name: str) -> str:
        return self.path("_checkpoints", name)

    @property
    def clean_path(self) -> str:
        return self.path("clean")

    def sink(self, name: str, mode: str | None = None) -> KeyedSink:
        """A result table; ``mode`` is ``replace`` for the running counts of a stateful query."""
        s, p = self.spark, self.path("tables", name)
        day = ["date"]  # a lookup reads the days of its batch only; closed days are compacted
        tables = {
            "ad_stat": (AD_STAT, ["date", "province", "city", "adid"], "add"),
            "ad_province_count": (AD_PROVINCE_TOP3, ["date", "province", "adid"], "add"),
            "ad_click_trend": (AD_CLICK_TREND, ["date", "hour", "minute", "adid"], "add"),
            "ad_user_click_count": (AD_USER_CLICK_COUNT, ["date", "userid", "adid"], "add"),
        }
        if name in tables:
            schema, keys, usual = tables[name]
            return KeyedSink(s, p, schema, keys, mode or usual, partition_cols=day)
        if name == "ad_province_top3":
            return KeyedSink(s, p, AD_PROVINCE_TOP3, ["date", "province", "adid"], "replace_group",
                             group_keys=["date", "province"], partition_cols=day)
        if name == "ad_blacklist":
            return KeyedSink(s, p, AD_BLACKLIST, ["userid"], "insert_absent")
        raise KeyError(name)

    def seed_blacklist(self, users: DataFrame) -> None:
        """Start from a list: version -1, before any batch's. Does nothing once a list is kept."""
        self.sink("ad_blacklist").apply(users, -1)


def _start(df_writer, name: str, store: AdStreamStore, trigger: dict | None,
           state_partitions: int | None = None) -> StreamingQuery:
    """Start with a checkpoint under the store. ``state_partitions`` fixes the number of shuffle /
    state-store partitions of a stateful query on its first start (later restarts keep the
    number recorded in the checkpoint)."""
    writer = (df_writer.option("checkpointLocation", store.checkpoint(name))
              .trigger(**(trigger or DEFAULT_TRIGGER))
              .queryName(f"ads_{name}_{os.path.basename(store.root.rstrip('/'))}"))
    if not state_partitions:
        return writer.start()
    with session_conf(store.spark, {"spark.sql.shuffle.partitions": state_partitions}):
        return writer.start()


# ---------------------------------------------------------------- clean clicks
def publish(store: AdStreamStore, batch_id: int, write) -> None:
    """Exactly-once output of a batch as files of ``clean/batch_id=<id>``: ``write(path)`` fills a staging folder, whose committed
    files are then moved. Whatever a crash leaves undone, the replay does: it writes only if the staging is
    not committed, moves only files still there, and does nothing once the batch is marked as moved."""
    files = Files(store.spark, store.root)
    batch, mark = f"batch_id={batch_id}", ("_moved", f"{batch_id:020d}")
    if files.exists(*mark):
        return
    if not files.exists("_staged", batch, "_SUCCESS"):
        write(store.path("_staged", batch))
    files.mkdirs("clean", batch)
    for name in files.names("_staged", batch, folders=False):
        if not name.startswith(("_", ".")):
            files.move(("_staged", batch, name), ("clean", batch, name))
    files.create("", *mark)
    files.delete("_staged", batch)
    for old in files.names("_moved")[:-2]:  # a replay is of the last batch
        files.delete("_moved", old)


def start_clean_clicks(lines: DataFrame, store: AdStreamStore,
                       trigger: dict | None = None, zone: str = "UTC") -> StreamingQuery:
    blacklist = store.sink("ad_blacklist")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            def write(path: str) -> None:
                quarantine(batch).write.mode("overwrite").text(store.path("quarantine", f"batch_id={batch_id}"))
                clicks = ads.drop_blacklisted(parse_ad_log(batch, zone), blacklist.snapshot())
                # by time, as the log comes: a file holds few days, and its readers touch only theirs
                n = max(1, -(-batch.count() // CLEAN_FILE_LINES))
                clicks.repartitionByRange(n, "ts").write.mode("overwrite").parquet(path)

            publish(store, batch_id, write)
        finally:
            batch.unpersist()

    return _start(lines.writeStream.foreachBatch(per_batch), "clean", store, trigger)


def clean_clicks(store: AdStreamStore, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the clean clicks written by ``start_clean_clicks``.

    The folder is created up front so readers can start before the first clean batch lands;
    ``batch_id=<id>`` sub-folders are discovered as a partition column.
    """
    spark = store.spark
    Files(spark, store.clean_path).mkdirs()
    schema = T.StructType(list(AD_CLICK.fields) + [T.StructField("batch_id", T.LongType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(store.clean_path).select(*AD_CLICK.fieldNames())


def event_time(ts_ntz: str = "ts"):
    """TIMESTAMP instant of a UTC wall-clock TIMESTAMP_NTZ (watermarks need TIMESTAMP)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_millis(F.timestamp_diff("MILLISECOND", epoch, F.col(ts_ntz)))


def _watermarked(clicks: DataFrame, watermark: str | None) -> DataFrame:
    out = clicks.withColumn("event_ts", event_time())
    return out.withWatermark("event_ts", watermark) if watermark else out


# ---------------------------------------------------------------- running counts + top 3
def running_ad_stat(clicks: DataFrame, watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    return (_watermarked(clicks, watermark)
            .groupBy(F.window("event_ts", "1 day"), "date", "province", "city", "adid")
            .agg(F.count(F.lit(1)).alias("click_count")))


def _each_batch(make):
    """A foreachBatch function that hands ``make(rows, batch_id)`` batches that are not empty."""
    def per_batch(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            if not rows.isEmpty():  # e.g. a watermark advance only
                make(rows, batch_id)
        finally:
            rows.unpersist()
    return per_batch


def start_ad_stat(clicks: DataFrame, store: AdStreamStore, watermark: str | None = DEFAULT_WATERMARK,
                  trigger: dict | None = None, top_k: int = 3,
                  state_partitions: int | None = None) -> StreamingQuery:
    top_sink, province_sink = store.sink("ad_province_top3"), store.sink("ad_province_count")
    group = ["date", "province"]
    if watermark:
        stat_sink = store.sink("ad_stat", "replace")

        def rerank(rows: DataFrame, batch_id: int) -> None:
            stat_sink.apply(rows, batch_id)
            current = stat_sink.lookup(rows.select(*group).distinct(), stat_sink.parts_of(batch_id))
            top_sink.apply(ads.province_top3(ads.province_count(current), top_k), batch_id)

        updates = running_ad_stat(clicks, watermark).select(*AD_STAT.fieldNames())
        return _start(updates.writeStream.outputMode("update").foreachBatch(_each_batch(rerank)), "stat", store, trigger, state_partitions)
    stat_sink = store.sink("ad_stat")

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = ads.ad_stat(batch)
        stat_sink.apply(counts, batch_id)
        # small next to the batch: one row per (date, province, ad) it holds
        provinces = ads.province_count(counts).persist()
        try:
            province_sink.apply(provinces, batch_id)
            days = province_sink.parts_of(batch_id)
            touched = province_sink.lookup(provinces.select(*group, "adid"), days)
            leaders = top_sink.lookup(provinces.select(*group).distinct(), days)
            others = leaders.join(provinces.select(*group, "adid").withColumnsRenamed({c: f"_{c}" for c in [*group, "adid"]}),
                                  reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, "adid"]]), "left_anti")
            top_sink.apply(ads.province_top3(touched.unionByName(others), top_k), batch_id)
        finally:
            provinces.unpersist()

    return _start(clicks.writeStream.foreachBatch(_each_batch(add)), "stat", store, trigger)


# ---------------------------------------------------------------- per-minute trend
def running_click_trend(clicks: DataFrame, watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    w = _watermarked(clicks, watermark)
    return (w.groupBy(F.window("event_ts", "1 minute"), ads.minute_of("ts").alias("minute_ts"), "adid")
            .agg(F.count(F.lit(1)).alias("click_count"))
            .select(*ads.trend_columns("minute_ts"), "adid", "click_count"))


def start_click_trend(clicks: DataFrame, store: AdStreamStore, watermark: str | None = DEFAULT_WATERMARK,
                      trigger: dict | None = None, state_partitions: int | None = None) -> StreamingQuery:
    if watermark:
        sink = store.sink("ad_click_trend", "replace")
        updates = running_click_trend(clicks, watermark).select(*AD_CLICK_TREND.fieldNames())
        return _start(updates.writeStream.outputMode("update").foreachBatch(_each_batch(sink.apply)), "trend", store, trigger, state_partitions)
    sink = store.sink("ad_click_trend")

    def add(batch: DataFrame, batch_id: int) -> None:
        sink.apply(ads.click_trend(batch), batch_id)

    return _start(clicks.writeStream.foreachBatch(_each_batch(add)), "trend", store, trigger)


# ---------------------------------------------------------------- blacklist maintenance
def start_blacklist(clicks: DataFrame, store: AdStreamStore, threshold: int = ads.BLACKLIST_THRESHOLD,
                    trigger: dict | None = None) -> StreamingQuery:
    counts_sink, blacklist_sink = store.sink("ad_user_click_count"), store.sink("ad_blacklist")

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = ads.user_click_count(batch).persist()
        try:
            counts_sink.apply(counts, batch_id)
            touched = counts_sink.lookup(counts.select("date", "userid", "adid"), counts_sink.parts_of(batch_id))
            users = ads.blacklist_candidates(touched, threshold).persist()
            if not users.isEmpty():
                blacklist_sink.apply(users, batch_id)
            users.unpersist()
        finally:
            counts.unpersist()

    return _start(clicks.writeStream.foreachBatch(_each_batch(add)), "blacklist", store, trigger)

"""Keyed sinks (replay, modes) and the streaming jobs (restart, feedback, watermark)."""

import os
import tempfile

import pytest

from conftest import rows
from shoplens.operators import ads
from shoplens.schema import AD_PROVINCE_TOP3, AD_STAT, AD_USER_CLICK_COUNT
from shoplens.sinks.keyed import KeyedSink
from shoplens.sources.adlog import read_ad_log_stream
from shoplens.streaming import ads as sads
from shoplens.streaming.ads import AdStreamStore

NOW = {"availableNow": True}


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="shoplens-test-")


def stat_rows(spark, data):
    return spark.createDataFrame(data, AD_STAT)


def test_replace_sink_replay_new_and_changed_keys(spark, root):
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_STAT, ["date", "province", "city", "adid"], "replace")
    sink.apply(stat_rows(spark, [("d", "p", "c", 1, 5), ("d", "p", "c", 2, 1)]), 0)
    b1 = stat_rows(spark, [("d", "p", "c", 1, 7), ("d", "p", "c", 3, 2)])
    sink.apply(b1, 1)
    sink.apply(b1, 1)  # replay of the same batch id
    assert rows(sink.snapshot()) == [("d", "p", "c", 1, 7), ("d", "p", "c", 2, 1), ("d", "p", "c", 3, 2)]
    assert sink.versions() == [0, 1]


def test_add_sink_is_idempotent_per_batch(spark, root):
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_USER_CLICK_COUNT, ["date", "userid", "adid"], "add")
    b = spark.createDataFrame([("d", 1, 1, 6)], AD_USER_CLICK_COUNT)
    sink.apply(b, 0)
    sink.apply(spark.createDataFrame([("d", 1, 1, 5), ("d", 2, 1, 1)], AD_USER_CLICK_COUNT), 1)
    sink.apply(spark.createDataFrame([("d", 1, 1, 5), ("d", 2, 1, 1)], AD_USER_CLICK_COUNT), 1)
    assert rows(sink.snapshot()) == [("d", 1, 1, 11), ("d", 2, 1, 1)]
    # 6 + 5 over two batches crosses the threshold
    assert rows(ads.blacklist_candidates(sink.snapshot())) == [(1,)]


def test_replace_group_shrinks(spark, root):
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_PROVINCE_TOP3, ["date", "province", "adid"],
                     "replace_group", group_keys=["date", "province"])
    sink.apply(spark.createDataFrame([("d", "p", 1, 9), ("d", "p", 2, 8), ("d", "p", 3, 7),
                                      ("d", "q", 1, 1)], AD_PROVINCE_TOP3), 0)
    sink.apply(spark.createDataFrame([("d", "p", 4, 20)], AD_PROVINCE_TOP3), 1)
    assert rows(sink.snapshot()) == [("d", "p", 4, 20), ("d", "q", 1, 1)]


def test_insert_absent(spark, root):
    from shoplens.schema import AD_BLACKLIST
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_BLACKLIST, ["userid"], "insert_absent")
    sink.apply(spark.createDataFrame([(1,), (1,)], AD_BLACKLIST), 0)
    sink.apply(spark.createDataFrame([(1,), (2,)], AD_BLACKLIST), 1)
    assert rows(sink.snapshot()) == [(1,), (2,)]


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _line(ms, user, ad, prov="p", city="c"):
    return f"{ms} {prov} {city} {user} {ad}"


DAY0 = 1704067200000  # 2024-01-01T00:00:00Z
DAY_MS = 86_400_000


def test_blacklist_feedback_drops_later_clicks(spark, root):
    store = AdStreamStore(spark, root)
    feed = os.path.join(root, "feed")
    # batch 0: user 7 clicks ad 1 eleven times -> blacklisted; batch 1: user 7 clicks again
    _write_lines(feed, "a.txt", [_line(DAY0 + i, 7, 1) for i in range(11)] + [_line(DAY0, 8, 1)])
    for step in range(2):
        lines = read_ad_log_stream(spark, feed)
        sads.start_clean_clicks(lines, store, NOW).awaitTermination()
        sads.start_blacklist(sads.clean_clicks(store), store, trigger=NOW).awaitTermination()
        if step == 0:
            _write_lines(feed, "b.txt", [_line(DAY0 + 100 + i, 7, 2) for i in range(3)] + [_line(DAY0 + 5, 8, 2)])
    assert rows(store.sink("ad_blacklist").snapshot()) == [(7,)]
    clean = spark.read.parquet(store.clean_path)
    assert clean.where("userid = 7 AND adid = 2").count() == 0
    assert clean.where("userid = 8").count() == 2


def test_stream_restart_equals_batch(spark, root):
    """Stop between batches, resume from the checkpoint, and get the batch result."""
    store = AdStreamStore(spark, root)
    feed = os.path.join(root, "feed")
    all_lines = []
    for day in range(3):
        lines = [_line(DAY0 + day * DAY_MS + i * 1000, u, ad, prov=str(u % 2))
                 for i, (u, ad) in enumerate([(1, 1), (2, 1), (3, 2), (1, 3), (2, 3), (2, 3)])]
        all_lines += lines
        _write_lines(feed, f"day{day}.txt", lines)
        # a fresh query object each time: state comes back from the checkpoint
        sads.start_clean_clicks(read_ad_log_stream(spark, feed), store, NOW).awaitTermination()
        sads.start_ad_stat(sads.clean_clicks(store), store, "1 day", NOW).awaitTermination()
        sads.start_click_trend(sads.clean_clicks(store), store, "1 day", NOW).awaitTermination()
    from shoplens.sources.adlog import parse_ad_log
    batch = parse_ad_log(spark.createDataFrame([(v,) for v in all_lines], "value string"))
    assert rows(store.sink("ad_stat").snapshot()) == rows(ads.ad_stat(batch))
    assert rows(store.sink("ad_province_top3").snapshot()) == \
        rows(ads.province_top3(ads.province_count(ads.ad_stat(batch))))
    assert rows(store.sink("ad_click_trend").snapshot()) == rows(ads.click_trend(batch))


def test_watermark_drops_events_beyond_delay(spark, root):
    store = AdStreamStore(spark, root)
    feed = os.path.join(root, "feed")
    _write_lines(feed, "a.txt", [_line(DAY0 + 5 * DAY_MS, 1, 1)])
    sads.start_clean_clicks(read_ad_log_stream(spark, feed), store, NOW).awaitTermination()
    sads.start_ad_stat(sads.clean_clicks(store), store, "1 day", NOW).awaitTermination()
    # within the delay (12 h late) and beyond it (3 days late)
    _write_lines(feed, "b.txt", [_line(DAY0 + 5 * DAY_MS - 43_200_000, 1, 1), _line(DAY0 + 2 * DAY_MS, 1, 1)])
    sads.start_clean_clicks(read_ad_log_stream(spark, feed), store, NOW).awaitTermination()
    sads.start_ad_stat(sads.clean_clicks(store), store, "1 day", NOW).awaitTermination()
    sads.start_ad_stat(sads.clean_clicks(store), store, "1 day", NOW).awaitTermination()
    got = {(r["date"], r["click_count"]) for r in store.sink("ad_stat").snapshot().collect()}
    assert got == {("20240106", 1), ("20240105", 1)}


def test_partitioned_sink_writes_only_touched_days(spark, root):
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_STAT, ["date", "province", "city", "adid"], "replace",
                     partition_cols=["date"])
    sink.apply(stat_rows(spark, [("d1", "p", "c", 1, 5), ("d2", "p", "c", 1, 1)]), 0)
    b1 = stat_rows(spark, [("d2", "p", "c", 1, 4), ("d2", "p", "c", 2, 2)])
    sink.apply(b1, 1)
    sink.apply(b1, 1)  # replay
    assert [(s["seq"], sorted(s["parts"])) for s in sink.manifest()["segments"]] == [(0, ["date=d1", "date=d2"]), (1, ["date=d2"])]
    assert rows(sink.snapshot()) == [("d1", "p", "c", 1, 5), ("d2", "p", "c", 1, 4), ("d2", "p", "c", 2, 2)]
    assert rows(sink.read_version(0)) == [("d1", "p", "c", 1, 5), ("d2", "p", "c", 1, 1)]
    add = KeyedSink(spark, os.path.join(root, "a"), AD_USER_CLICK_COUNT, ["date", "userid", "adid"], "add",
                    partition_cols=["date"])
    for b in range(3):
        add.apply(spark.createDataFrame([("20240101", 1, 1, 2), (f"2024010{b + 2}", 1, 1, 1)],
                                        AD_USER_CLICK_COUNT), b)
    assert rows(add.snapshot()) == [("20240101", 1, 1, 6), ("20240102", 1, 1, 1), ("20240103", 1, 1, 1),
                                    ("20240104", 1, 1, 1)]


def test_compaction_and_retention_keep_results(spark, root):
    path = os.path.join(root, "c")
    sink = KeyedSink(spark, path, AD_USER_CLICK_COUNT, ["date", "userid", "adid"], "add",
                     partition_cols=["date"], compact_every=3)
    want = {}
    for b in range(8):
        day = f"2024010{b % 3 + 1}"
        batch = [(day, 1, 1, b + 1), ("20240109", 2, 2, 1)]
        for d, u, a, n in batch:
            want[(d, u, a)] = want.get((d, u, a), 0) + n
        sink.apply(spark.createDataFrame(batch, AD_USER_CLICK_COUNT), b)
        if b == 5:
            sink.apply(spark.createDataFrame(batch, AD_USER_CLICK_COUNT), b)  # replay
    assert {(r[0], r[1], r[2]): r[3] for r in sink.snapshot().collect()} == want
    assert max(s["level"] for s in sink.manifest()["segments"]) > 0
    named = {s["dir"] for n in sink._numbers() for s in sink._manifest(n)["segments"]}
    there = {f"{q}/{t}" for q in os.listdir(os.path.join(path, "data")) for t in os.listdir(os.path.join(path, "data", q))}
    assert there == named  # what no kept manifest names is deleted


def test_continuous_job_all_queries(spark, root):
    """The production entry point: four queries running at once on a processing-time trigger."""
    from shoplens.plans.jobs import start_ad_stream_job
    from shoplens.sources.adlog import parse_ad_log
    feed = os.path.join(root, "feed")
    lines = [_line(DAY0 + i * 60_000, u, u % 3, prov=str(u % 2)) for i, u in enumerate([1, 2, 3, 1, 2, 1] * 4)]
    _write_lines(feed, "a.txt", lines)
    store, queries = start_ad_stream_job(spark, read_ad_log_stream(spark, feed), root,
                                         trigger={"processingTime": "1 second"})
    try:
        for q in queries:  # the clean query first, then the readers of its output
            q.processAllAvailable()
        for q in queries[1:]:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
    batch = parse_ad_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert rows(store.sink("ad_stat").snapshot()) == rows(ads.ad_stat(batch))
    assert rows(store.sink("ad_click_trend").snapshot()) == rows(ads.click_trend(batch))
    assert rows(store.sink("ad_user_click_count").snapshot()) == rows(ads.user_click_count(batch))


def test_partition_values_escaped_or_null(spark, root):
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_USER_CLICK_COUNT, ["date", "userid", "adid"], "add",
                     partition_cols=["date"])
    sink.apply(spark.createDataFrame([("2024:01", 1, 1, 5), ("2024:01", 2, 1, 7), (None, 1, 1, 1)],
                                     AD_USER_CLICK_COUNT), 0)
    sink.apply(spark.createDataFrame([("2024:01", 1, 1, 1), (None, 1, 1, 1)], AD_USER_CLICK_COUNT), 1)
    assert {tuple(r) for r in sink.snapshot().collect()} == {("2024:01", 1, 1, 6), ("2024:01", 2, 1, 7), (None, 1, 1, 2)}


def test_readers_keep_files(spark, root):
    plain = KeyedSink(spark, os.path.join(root, "p"), AD_STAT, ["date", "province", "city", "adid"], "replace", compact_every=2)
    plain.apply(stat_rows(spark, [("d", "p", "c", 1, 0)]), 0)
    before = plain.snapshot()
    for b in (1, 2, 3):
        plain.apply(stat_rows(spark, [("d", "p", "c", 1, b)]), b)
    assert rows(before) == [("d", "p", "c", 1, 0)]
    assert rows(plain.snapshot()) == [("d", "p", "c", 1, 3)]


COUNTS = ["date", "userid", "adid"]


def counts_sink(spark, root, **options):
    return KeyedSink(spark, os.path.join(root, "n"), AD_USER_CLICK_COUNT, COUNTS, "add", partition_cols=["date"], **options)


def test_cost_of_a_batch_follows_the_batch(spark, root):
    """A one-row batch writes one row beside a day of many thousand."""
    sink = counts_sink(spark, root)
    big = spark.range(200_000).selectExpr("'20240101' AS date", "id AS userid", "id % 7 AS adid", "1L AS click_count")
    sink.apply(big, 0)
    sink.apply(spark.createDataFrame([("20240101", 5, 5, 2)], AD_USER_CLICK_COUNT), 1)
    old, new = sink.manifest()["segments"]
    assert new["bytes"] < old["bytes"] / 50
    assert rows(sink.lookup(spark.createDataFrame([("20240101", 5, 5), ("20240101", 6, 6)], "date string, userid long, adid long"),
                            sink.parts_of(1))) == [("20240101", 5, 5, 3), ("20240101", 6, 6, 1)]


def test_crash_before_the_manifest_is_no_batch(spark, root, monkeypatch):
    sink = counts_sink(spark, root)
    one = spark.createDataFrame([("d1", 1, 1, 1)], AD_USER_CLICK_COUNT)
    sink.apply(one, 0)
    monkeypatch.setattr(KeyedSink, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sink.apply(one, 1)
    monkeypatch.undo()
    again = counts_sink(spark, root)  # a new process
    assert rows(again.snapshot()) == [("d1", 1, 1, 1)] and again.versions() == [0]
    again.apply(one, 1)
    assert rows(again.snapshot()) == [("d1", 1, 1, 2)]


def test_a_manifest_is_never_replaced(spark, root):
    sink = counts_sink(spark, root)
    sink.apply(spark.createDataFrame([("d1", 1, 1, 1)], AD_USER_CLICK_COUNT), 0)
    with pytest.raises(Exception):
        sink.files.create("{}", "_log", f"{0:020d}.json")
    assert sink.manifest()["batch"] == 0


@pytest.mark.parametrize("mode,background", [("replace", False), ("add", False), ("add", True), ("replace_group", False), ("insert_absent", False)])
def test_log_equals_a_plain_table(spark, root, mode, background):
    """Random batches with null keys, each mode, compaction at every other batch, against a plain dictionary."""
    import random
    r = random.Random(f"{mode}")
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_USER_CLICK_COUNT, COUNTS, mode, group_keys=["date", "userid"],
                     partition_cols=["date"], compact_every=2, background=background)
    want = {}
    for b in range(7):
        day = b // 3
        batch = {(r.choice([f"d{day}", f"d{max(0, day - 1)}", None]), r.choice([1, 2, None]), r.randint(0, 3)): r.randint(1, 9) for _ in range(5)}
        if mode == "replace_group":
            groups = {k[:2] for k in batch}
            want = {k: v for k, v in want.items() if k[:2] not in groups}
        for k, v in batch.items():
            if mode == "add":
                want[k] = want.get(k, 0) + v
            elif mode != "insert_absent" or k not in want:
                want[k] = v
        sink.apply(spark.createDataFrame([(*k, v) for k, v in batch.items()], AD_USER_CLICK_COUNT), b)
        got = {tuple(x)[:3]: x[3] for x in sink.snapshot().collect()}
        assert got == want
        some = r.choice(sorted(want, key=str))
        key = spark.createDataFrame([some], "date string, userid long, adid long")
        assert [x[3] for x in sink.lookup(key).collect()] == [want[some]]
    sink.wait()
    assert {tuple(x)[:3]: x[3] for x in sink.snapshot().collect()} == want
    assert len(sink.manifest()["segments"]) <= 6


def test_closed_days_become_one_segment(spark, root):
    sink = counts_sink(spark, root, compact_every=3)
    for b in range(12):
        sink.apply(spark.createDataFrame([(f"d{b // 4}", 1, 1, 1)], AD_USER_CLICK_COUNT), b)
    times = [sum(p in s["parts"] for s in sink.manifest()["segments"]) for p in ("date=d0", "date=d1")]
    assert times == [1, 1]
    assert rows(sink.snapshot()) == [("d0", 1, 1, 4), ("d1", 1, 1, 4), ("d2", 1, 1, 4)]


def test_half_published_batch_and_its_replay(spark, root, monkeypatch):
    """A crash between two moved files: the replay moves the rest and writes nothing anew."""
    from shoplens.sinks.files import Files
    store = AdStreamStore(spark, root)
    written = []

    def write(path):
        written.append(path)
        spark.range(100).repartition(4).write.mode("overwrite").parquet(path)

    move, moved = Files.move, []

    def twice(self, source, target):
        if source[0] == "_staged" and len(moved) == 2:
            raise OSError("lost")
        moved.append(target)
        move(self, source, target)

    monkeypatch.setattr(Files, "move", twice)
    with pytest.raises(OSError):
        sads.publish(store, 0, write)
    monkeypatch.undo()
    assert 0 < spark.read.parquet(store.clean_path).count() < 100
    sads.publish(store, 0, write)
    sads.publish(store, 0, write)
    assert len(written) == 1
    assert sorted(r.id for r in spark.read.parquet(store.clean_path).collect()) == list(range(100))
    sads.publish(store, 1, write)
    assert spark.read.parquet(store.clean_path).count() == 200


def test_stream_starts_from_a_list(spark, root):
    store = AdStreamStore(spark, root)
    store.seed_blacklist(spark.createDataFrame([(8,)], "userid long"))
    store.seed_blacklist(spark.createDataFrame([(9,)], "userid long"))  # a restart: the list is kept as it is
    feed = os.path.join(root, "feed")
    _write_lines(feed, "a.txt", [_line(DAY0 + i, 7, 1) for i in range(11)] + [_line(DAY0, 8, 1), _line(DAY0, 9, 1)])
    sads.start_clean_clicks(read_ad_log_stream(spark, feed), store, NOW).awaitTermination()
    assert sorted({r.userid for r in spark.read.parquet(store.clean_path).collect()}) == [7, 9]
    sads.start_blacklist(sads.clean_clicks(store), store, trigger=NOW).awaitTermination()
    assert rows(store.sink("ad_blacklist").snapshot()) == [(7,), (8,)]


def test_top3_by_kept_leaders(spark, root):
    """Leaders from the old ones and the touched ads equal those of all counts, batch by batch, without a state store."""
    import random
    r = random.Random(3)
    store = AdStreamStore(spark, root)
    feed, seen = os.path.join(root, "feed"), []
    from shoplens.sources.adlog import parse_ad_log
    for step in range(4):
        lines = [_line(DAY0 + r.randint(0, 1) * DAY_MS, 1, r.randint(0, 6), prov=r.choice("pq"), city=r.choice("ab")) for _ in range(40)]
        seen += lines
        _write_lines(feed, f"{step}.txt", lines)
        sads.start_clean_clicks(read_ad_log_stream(spark, feed), store, NOW).awaitTermination()
        q = sads.start_ad_stat(sads.clean_clicks(store), store, trigger=NOW)
        q.awaitTermination()
        assert not any(p["stateOperators"] for p in q.recentProgress)
        batch = parse_ad_log(spark.createDataFrame([(v,) for v in seen], "value string"))
        assert rows(store.sink("ad_stat").snapshot()) == rows(ads.ad_stat(batch))
        assert rows(store.sink("ad_province_top3").snapshot()) == rows(ads.province_top3(ads.province_count(ads.ad_stat(batch))))


def test_sliding_sums_of_any_width(spark):
    """Windows of several widths and slides, over days with gaps, against Spark's own windows."""
    from pyspark.sql import functions as F
    import random
    r = random.Random(4)
    times = [r.choice([0, 1400, 2880, 4300]) + r.randint(0, 200) for _ in range(150)]
    clicks = spark.createDataFrame([(t * 60 + r.randint(0, 59), r.randint(0, 2)) for t in times], "s long, adid long").select(
        F.timestamp_add("SECOND", F.col("s"), F.lit("2023-12-31 00:00:00").cast("timestamp_ntz")).alias("ts"), "adid")
    for width, slide in ((60, 1), (60, 5), (7, 3), (3000, 60), (5, 10)):
        plain = (clicks.groupBy(F.window("ts", f"{width} minutes", f"{slide} minutes").alias("w"), "adid")
                 .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.end").alias("window_end"), "adid", "n")) if slide <= width else None
        got = ads.sliding_hour(clicks, width, slide)
        if plain is not None:
            assert rows(got) == rows(plain)
    assert rows(ads.sliding_hour(clicks.limit(0))) == []


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("mode", ["add", "replace", "replace_group"])
def test_files_of_a_segment_follow_its_days(spark, root, mode, adaptive):
    """Kept rows dealt by key over 16 tasks: a day is a file, not a file a task."""
    from shoplens.runtime import session_conf
    counts = spark.range(600).selectExpr("concat('2024010', id % 3) AS date", "id AS userid", "id % 7 AS adid", "id AS click_count")
    sink = KeyedSink(spark, os.path.join(root, "t"), AD_USER_CLICK_COUNT, COUNTS, mode, group_keys=["date", "userid"],
                     partition_cols=["date"], compact_every=2)
    with session_conf(spark, {"spark.sql.adaptive.enabled": adaptive}):
        kept = counts.repartition(16, *COUNTS).persist()
        try:
            sink.apply(kept, 0)
            assert len(_files(sink.path)) == 3
            sink.apply(kept, 1)  # and so do merged ones
            assert [len(_files(os.path.join(sink.path, "data", s["dir"]))) for s in sink.manifest()["segments"]] == [3]
        finally:
            kept.unpersist()
        times = 2 if mode == "add" else 1
        assert rows(sink.snapshot()) == rows(counts.withColumn("click_count", counts.click_count * times))


def _ten_files(root):
    """A log of two days in ten files: what one batch of the clean query reads in many tasks."""
    feed = os.path.join(root, "feed")
    lines = [_line(DAY0 + i * 600_000, i % 3, i % 4, prov=str(i % 2)) for i in range(250)]
    for k in range(10):
        _write_lines(feed, f"{k}.txt", lines[k::10])
    return feed, lines


def test_clean_files_follow_the_lines_of_a_batch(spark, root, monkeypatch):
    """Clean files, and with them the batches of a reader by files, do not multiply with the tasks that write them."""
    from shoplens.sources.adlog import parse_ad_log
    feed, lines = _ten_files(root)
    want = parse_ad_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    whole = AdStreamStore(spark, os.path.join(root, "whole"))
    sads.start_clean_clicks(read_ad_log_stream(spark, feed), whole, NOW).awaitTermination()
    assert len(_files(whole.clean_path)) == 1
    q = sads.start_blacklist(sads.clean_clicks(whole, max_files_per_trigger=1), whole, trigger=NOW)
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress] == [250]
    assert rows(whole.sink("ad_blacklist").snapshot()) == [(0,), (1,), (2,)]
    monkeypatch.setattr(sads, "CLEAN_FILE_LINES", 100)
    cut = AdStreamStore(spark, os.path.join(root, "cut"))
    sads.start_clean_clicks(read_ad_log_stream(spark, feed), cut, NOW).awaitTermination()
    spans = [spark.read.parquet(f).agg({"ts": "min"}).union(spark.read.parquet(f).agg({"ts": "max"})).collect() for f in sorted(_files(cut.clean_path))]
    times = [r[0] for span in spans for r in span]
    assert len(spans) == 3 and times == sorted(times)
    for store in (cut, whole):
        assert rows(spark.read.parquet(store.clean_path).select(*want.columns)) == rows(want)


def test_stat_of_many_files_is_one_small_batch(spark, root):
    """The counts of a batch, kept in as many tasks as the session shuffles by, leave a file a day in each table."""
    from shoplens.runtime import session_conf
    from shoplens.sources.adlog import parse_ad_log
    feed, lines = _ten_files(root)
    store = AdStreamStore(spark, root)
    with session_conf(spark, {"spark.sql.shuffle.partitions": 40}):
        sads.start_clean_clicks(read_ad_log_stream(spark, feed), store, NOW).awaitTermination()
        q = sads.start_ad_stat(sads.clean_clicks(store, max_files_per_trigger=1), store, trigger=NOW)
        q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress] == [250]
    batch = parse_ad_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    for name in ("ad_stat", "ad_province_count"):
        assert len(_files(store.path("tables", name))) == 2
    assert rows(store.sink("ad_stat").snapshot()) == rows(ads.ad_stat(batch))


def test_top3_of_many_files_and_batches(spark, root, monkeypatch):
    """Leaders over several clean files of a batch, each a batch of its own, equal those of all clicks; a day is a file a batch."""
    from shoplens.runtime import session_conf
    from shoplens.sources.adlog import parse_ad_log
    feed, lines = _ten_files(root)
    store = AdStreamStore(spark, root)
    monkeypatch.setattr(sads, "CLEAN_FILE_LINES", 125)
    with session_conf(spark, {"spark.sql.shuffle.partitions": 40}):
        sads.start_clean_clicks(read_ad_log_stream(spark, feed), store, NOW).awaitTermination()
        q = sads.start_ad_stat(sads.clean_clicks(store, max_files_per_trigger=1), store, trigger=NOW)
        q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 2
    segments = store.sink("ad_province_top3").manifest()["segments"]
    for name in ("ad_province_count", "ad_province_top3"):
        assert len(_files(store.path("tables", name))) == sum(len(s["parts"]) for s in segments)
    batch = parse_ad_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert rows(store.sink("ad_province_top3").snapshot()) == rows(ads.province_top3(ads.province_count(ads.ad_stat(batch))))

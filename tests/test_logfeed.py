"""The stored log as a stream: starts, restarts in the middle of a file, cut ranges, half lines, replaced files."""

import pytest

from conftest import rows
from shoplens.sources.logfeed import LogReader, Range, read_log_feed

NOW = {"availableNow": True}


def take(spark, folder, root, **options):
    """All lines that one run brings; the run's checkpoint stays in ``root``."""
    seen = []
    lines = read_log_feed(spark, str(folder), **options)
    q = (lines.writeStream.foreachBatch(lambda b, _: seen.extend(tuple(r) for r in b.collect())).trigger(**NOW)
         .option("checkpointLocation", str(root)).start())
    q.awaitTermination()
    return sorted(seen, key=lambda r: (r[1], r[2]))


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a").write_text("one\ntwo\nhalf")
    (folder / "_hidden").write_text("no\n")
    return folder


def test_restart_goes_on_in_the_middle_of_a_file(spark, log, tmp_path):
    root = tmp_path / "checkpoint"
    assert take(spark, log, root) == [("one", "a", 0), ("two", "a", 4)]
    assert take(spark, log, root) == []
    with open(log / "a", "a") as f:
        f.write(" line\r\nthree\n")
    (log / "b").write_text("\nß\n")
    assert take(spark, log, root) == [("half line", "a", 8), ("three", "a", 19), ("", "b", 0), ("ß", "b", 1)]


def test_starts(spark, log, tmp_path):
    assert take(spark, log, tmp_path / "c1", starting="latest") == []
    with open(log / "a", "a") as f:
        f.write("\nnew\n")
    assert [r[0] for r in take(spark, log, tmp_path / "c1", starting="latest")] == ["half", "new"]
    (log / "b").write_text("other\n")
    assert [r[0] for r in take(spark, log, tmp_path / "c2", starting={"a": 4})] == ["two", "half", "new", "other"]


@pytest.mark.parametrize("size", [1, 3, 7, 64, 1 << 20])
def test_ranges_may_be_cut_anywhere(log, size):
    text = "".join(f"line {i} {'x' * (i % 11)}\n" for i in range(60)) + "\n\n"
    (log / "c").write_text(text)
    reader = LogReader({"path": str(log), "rangeBytes": size})
    parts = reader.partitions({}, {"c": len(text)})
    assert sum(p.end - p.begin for p in parts) == len(text)
    got = [r for p in parts for r in reader.read(p)]
    assert [r[0] for r in got] == text.split("\n")[:-1]
    assert all(text[r[2]:].startswith(r[0]) for r in got)


def test_offsets(log):
    reader = LogReader({"path": f"file:{log}"})
    assert reader.initialOffset() == {} and reader.latestOffset() == {"a": 8}
    assert reader.partitions({"a": 8}, {"a": 8}) == []
    with pytest.raises(ValueError, match="replaced"):
        reader.partitions({"a": 9}, {"a": 8})
    with pytest.raises(ValueError, match="path"):
        LogReader({})
    (log / "empty").write_text("")
    (log / "nobreak").write_text("x" * 10)
    assert reader.latestOffset() == {"a": 8, "empty": 0, "nobreak": 0}
    assert list(reader.read(Range("a", 0, 8))) == [("one", "a", 0), ("two", "a", 4)]


def test_counts_of_a_log_that_grows_between_runs(spark, tmp_path):
    """The whole job over the feed: runs that end and go on give what one batch over the log gives."""
    from shoplens.operators import ads
    from shoplens.sources.adlog import parse_ad_log
    from shoplens.streaming import ads as sads
    folder = tmp_path / "log"
    folder.mkdir()
    store, every = sads.AdStreamStore(spark, str(tmp_path / "root")), []
    for step in range(3):
        lines = [f"{1704067200000 + step * 86_400_000 + i * 1000} p c {i % 3} {i % 4}" for i in range(20)]
        every += lines
        with open(folder / "clicks", "a") as f:
            f.write("\n".join(lines) + "\n")
        sads.start_clean_clicks(read_log_feed(spark, str(folder)).select("value"), store, NOW).awaitTermination()
        sads.start_ad_stat(sads.clean_clicks(store), store, trigger=NOW).awaitTermination()
    batch = parse_ad_log(spark.createDataFrame([(v,) for v in every], "value string"))
    assert rows(store.sink("ad_stat").snapshot()) == rows(ads.ad_stat(batch))

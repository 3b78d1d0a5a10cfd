"""Physical-plan properties: pushdown, pruning, broadcast of fixed-size sides, top-k limits,
and no Python evaluation anywhere."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

STREAMING = ("_stream", "upsert_")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in entry.queries() if not any(t in k for t in STREAMING)))
def test_no_python_udfs(spark, key):
    p = plan(entry.queries()[key](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_click_scan_pushdown_and_pruning(spark):
    p = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(entry.queries()["click_scan"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", p)
    # only what the adapter's expressions for the three columns and the date need is read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_area_dimension_is_broadcast_and_topk_is_limited(spark):
    df = entry.queries()["area_top3"](spark, SF_SMALL)
    df.collect()
    text = plan(df)
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text
    assert "WindowGroupLimit" in text


def test_top10_uses_take_ordered(spark):
    text = plan(entry.queries()["top10_category"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_sampling_ranks_cells_not_hours(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(entry.queries()["session_extract"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ranks = [line for line in text.split("\n") if "Window [row_number()" in line]
    assert ranks and all("_cell#" in line for line in ranks)


def _event_scans(df) -> int:
    import re
    text = plan(df)
    return len(re.findall(r"FileScan parquet [^\n]*events\.parquet", text))


@pytest.mark.parametrize("key", ["filtered_actions", "category_funnel", "top10_category",
                                 "page_convert_rate", "page_pair_count", "session_stat_ratio"])
def test_actions_scanned_once(spark, key):
    """Page pairs scan once more, for the sample that finds hot sessions."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = entry.queries()[key](spark, SF_SMALL)
        assert _event_scans(df) == (2 if key.startswith("page") else 1)
        assert plan(df).count("Sample ") == (1 if key.startswith("page") else 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ad_log_is_split_once(spark):
    text = plan(entry.queries()["ad_log_parsed"](spark, SF_SMALL))
    assert text.count("split(") == 1


def test_sliding_hour_has_no_row_per_minute_before_its_sums(spark):
    text = plan(entry.queries()["ad_sliding_hour"](spark, SF_SMALL))
    before = text[text.index("Window ["):]  # what feeds the running sum
    assert "Expand" not in text and "sequence" not in before and "Generate inline" in before


def test_recent_hour_reads_the_log_once(spark):
    """Its counts are written down: the plan starts from them."""
    assert _event_scans(entry.queries()["ad_recent_hour"](spark, SF_SMALL)) == 0


def test_category_path_needs_no_session_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(entry.queries()["filtered_actions"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "hashpartitioning(session_id" not in text

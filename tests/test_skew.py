"""A key holding about a third of all rows: results stay exact and whole, and the plans keep the
hot group out of a single task where the operator allows it."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from shoplens.operators import ads, category, ordered, pageflow, sampling, sessions
from shoplens.schema import USER_VISIT_ACTION

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _actions(spark, n_hot=3000, n_cold=60, cold_len=100, seed=3):
    rnd = random.Random(seed)
    data = []
    # the hot session spans 40 hours; it holds a third of all rows
    for i in range(n_hot):
        t = T0 + dt.timedelta(seconds=i * 48)
        data.append(("2024-01-01", 1, "hot", rnd.randint(0, 9), t, None, rnd.choice([-1, 7]),
                     -1, None, None, None, None, 0))
    for s in range(n_cold):
        for i in range(cold_len):
            t = T0 + dt.timedelta(hours=s % 24, seconds=i * 3)
            data.append(("2024-01-01", 2 + s, f"c{s}", rnd.randint(0, 9), t, None,
                         rnd.choice([-1, 7, 8]), -1, None, None, None, None, 0))
    return spark.createDataFrame(data, USER_VISIT_ACTION)


def _pairs_in_one_pass(acts):
    w = Window.partitionBy("session_id").orderBy("action_time", "page_id")
    return (acts.withColumn("next_page_id", F.lead("page_id").over(w))
            .where(F.col("next_page_id").isNotNull()).select("session_id", "page_id", "next_page_id"))


def test_hot_session_pairs_are_exact_and_spread(spark):
    """A third of all rows in one session: over 40 hours, within one hour, and all at one instant."""
    wide = _actions(spark)
    hot = F.col("session_id") == "hot"
    hour = wide.withColumn("action_time", F.when(hot, F.timestamp_add("SECOND", F.pmod(F.hash("action_time"), F.lit(3600)),
                                                                      F.lit(T0).cast("timestamp_ntz"))).otherwise(F.col("action_time")))
    instant = wide.withColumns({"action_time": F.when(hot, F.lit(T0).cast("timestamp_ntz")).otherwise(F.col("action_time")),
                                "page_id": F.when(hot, F.lit(3)).otherwise(F.col("page_id"))})
    for acts in (wide, hour, instant):
        assert rows(pageflow.page_pairs(acts, 16)) == rows(_pairs_in_one_pass(acts))
        placed = ordered.in_pieces(acts.select("session_id", "action_time", "page_id"), "session_id", ["action_time", "page_id"], 16)
        sizes = [r["count"] for r in placed.where(hot).groupBy("_piece").count().collect()]
        assert len(sizes) >= 6 and max(sizes) < 9000 / 16 * 2.5
        assert placed.where(~hot & F.col("_piece").isNotNull()).count() == 0


def test_pairs_of_null_sessions_and_empty_tables(spark):
    acts = _actions(spark).withColumn("session_id", F.nullif("session_id", F.lit("hot")))
    assert rows(pageflow.page_pairs(acts, 16)) == rows(_pairs_in_one_pass(acts))
    assert pageflow.page_pairs(acts.limit(0)).count() == 0


def test_hot_session_summary_uses_partial_aggregation(spark):
    acts = _actions(spark)
    summary = sessions.public(sessions.session_summary(acts))
    hot = summary.where("session_id = 'hot'").first()
    assert hot["step_length"] == 3000 and hot["visit_length"] == 2999 * 48
    assert "partial_count" in _plan(summary) or "partial_min" in _plan(summary)


def test_hot_category_top_sessions_exact_with_partial_limit(spark):
    acts = _actions(spark)
    counts = category.session_category_clicks(acts, spark.createDataFrame([(7,), (8,)], "category_id bigint"))
    top = category.top_sessions(counts, 10)
    want = {}
    for cat, sid, n in rows(counts):
        want.setdefault(cat, []).append((-n, sid))
    expect = sorted((c, sid, -negn) for c, lst in want.items() for negn, sid in sorted(lst)[:10])
    assert sorted(rows(top)) == expect
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "WindowGroupLimit" in _plan(top) and "Partial" in _plan(top)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_hour_sample_respects_quota(spark):
    # 900 sessions start in one hour, 30 in others
    data = []
    for i in range(900):
        data.append(("2024-01-01", i, f"h{i}", 1, T0 + dt.timedelta(hours=9, seconds=i), None, -1, -1,
                     None, None, None, None, 0))
    for i in range(30):
        data.append(("2024-01-01", i, f"o{i}", 1, T0 + dt.timedelta(hours=i % 24, minutes=30), None, -1,
                     -1, None, None, None, None, 0))
    summary = sessions.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION))
    quota = sampling.extract_quota(sampling.hour_counts(summary), total=100)
    picked = sampling.extract_sessions(summary, quota, total=100)
    by_hour = {(r["date"], r["hour"]): r["quota"] for r in quota.collect()}
    assert by_hour[("2024-01-01", "09")] == 900 * 100 // 930
    got = picked.withColumn("hour", F.date_format("start_time", "HH")).groupBy("hour").count().collect()
    for r in got:
        assert r["count"] == by_hour[("2024-01-01", r["hour"])]


def test_click_flood_blacklist_and_counts_are_whole(spark):
    lines = [(f"{1704067200000 + i} 1 1 0 0",) for i in range(3000)]
    lines += [(f"{1704067200000 + i} 1 1 {u} {u % 5}",) for u in range(1, 200) for i in range(30)]
    from shoplens.sources.adlog import parse_ad_log
    clicks = parse_ad_log(spark.createDataFrame(lines, "value string"))
    counts = ads.user_click_count(clicks)
    assert counts.agg(F.sum("click_count")).first()[0] == len(lines)
    assert len(rows(ads.blacklist_candidates(counts))) == 200

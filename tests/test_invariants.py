"""Invariants across keys on the driver's data."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL, rows


def q(spark, key):
    return entry.queries()[key](spark, SF_SMALL)


def test_histogram_totals(spark):
    s = q(spark, "session_filtered")
    n = s.count()
    zero = s.where("visit_length = 0").count()
    hist = {(r["kind"], r["bucket"]): r["cnt"] for r in q(spark, "session_histogram").collect()}
    assert sum(v for (k, _), v in hist.items() if k == "visit_length") + zero == n
    assert sum(v for (k, _), v in hist.items() if k == "step_length") == n
    assert q(spark, "session_stat_ratio").first()["session_count"] == n


def test_funnel_totals_equal_exploded_rows(spark):
    fa = q(spark, "filtered_actions")
    clicks = fa.where("click_category_id <> -1").count()
    orders = fa.select(F.explode(F.split("order_category_ids", ",")).alias("x")).where("x <> ''").count()
    pays = fa.select(F.explode(F.split("pay_category_ids", ",")).alias("x")).where("x <> ''").count()
    tot = q(spark, "category_funnel").agg(*[F.sum(c).alias(c) for c in
                                            ("click_count", "order_count", "pay_count")]).first()
    assert (tot["click_count"], tot["order_count"], tot["pay_count"]) == (clicks, orders, pays)
    assert q(spark, "active_categories").count() == q(spark, "category_funnel").count()


def test_top_k_are_subsets(spark):
    top = set(rows(q(spark, "top_sessions_per_category")))
    assert top <= set(rows(q(spark, "session_category_count")))
    top10 = set(rows(q(spark, "top10_category")))
    assert len(top10) <= 10 and top10 <= set(rows(q(spark, "category_funnel")))
    info = {(r["area"], r["pid"], r["click_count"]) for r in q(spark, "area_product_info").collect()}
    assert {(r["area"], r["pid"], r["click_count"]) for r in q(spark, "area_top3").collect()} <= info
    prov = set(rows(q(spark, "ad_province_count")))
    assert set(rows(q(spark, "ad_province_top3"))) <= prov


def test_sample_within_quota_and_sessions(spark):
    quota = {(r["date"], r["hour"]): r["quota"] for r in q(spark, "session_extract_quota").collect()}
    ex = q(spark, "session_extract")
    got = ex.groupBy(F.date_format("start_time", "yyyy-MM-dd").alias("d"),
                     F.date_format("start_time", "HH").alias("h")).count().collect()
    assert all(r["count"] <= quota[(r["d"], r["h"])] for r in got)
    assert {r[0] for r in ex.select("session_id").collect()} <= \
        {r[0] for r in q(spark, "session_filtered").select("session_id").collect()}


def test_ad_counts_are_whole(spark):
    n = q(spark, "ad_log_parsed").count()
    for key in ("ad_stat", "ad_user_click_count", "ad_click_trend"):
        assert q(spark, key).agg(F.sum("click_count")).first()[0] == n

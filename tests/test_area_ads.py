"""Edge fixtures for area top-3, JSON status, the ad-log parser and the blacklist rules."""

import datetime as dt

from conftest import rows
from shoplens.operators import ads, area
from shoplens.schema import AD_BLACKLIST, PRODUCT_INFO
from shoplens.sources.adlog import parse_ad_log, quarantine
from shoplens.sources.city_area import city_area


def test_city_list_distinct_sorted_and_prefix_safe(spark):
    basic = spark.createDataFrame(
        [(1, "x", "A", 7), (11, "x", "A", 7), (1, "x", "A", 7), (None, None, "A", 7), (2, "y", "A", 7)],
        "city_id bigint, city_name string, area string, pid bigint").repartition(3)
    got = rows(area.area_click_count(basic))
    # '1:x' survives next to '11:x' (binary string order); the null city contributes nothing;
    # all 5 clicks are counted
    assert got == [("A", 7, 5, "11:x,1:x,2:y")]


def test_product_status_from_json(spark):
    products = spark.createDataFrame(
        [(1, "p1", '{"product_status": 0}'), (2, "p2", '{"product_status": "0"}'),
         (3, "p3", '{"product_status": 1}'), (4, "p4", '{"other": 0}'), (5, "p5", None),
         (6, "p6", "not json")], PRODUCT_INFO)
    got = dict(rows(products.select("product_id", area.product_status("extend_info"))))
    assert got == {1: "Self", 2: "Self", 3: "Third Party", 4: "Third Party", 5: "Third Party",
                   6: "Third Party"}


def test_area_top3_ties_by_pid_and_levels(spark):
    clicks = spark.createDataFrame([(0, p) for p in (5, 5, 6, 6, 7, 7, 8)] + [(9, 1)],
                                   "city_id bigint, click_product_id bigint")
    products = spark.createDataFrame([(p, f"p{p}", '{"product_status": 0}') for p in range(10)],
                                     PRODUCT_INFO)
    info = area.area_product_info(area.area_click_count(area.area_click_basic(clicks, city_area(spark))),
                                  products)
    top = area.area_top3(info).select("area", "area_level", "pid", "click_count").collect()
    got = sorted((r["area_level"], r["pid"], r["click_count"]) for r in top)
    assert got == [("A_Level", 5, 2), ("A_Level", 6, 2), ("A_Level", 7, 2), ("D_Level", 1, 1)]


def test_ad_log_quarantine(spark):
    lines = spark.createDataFrame(
        [("1704067200000 1 2 3 4",), ("1704067200000 1 2 3",), ("1704067200000 1 2 x 4",),
         ("1704067200000 1 2 3 4 5",), ("1704067200000  1 2 3",), ("abc 1 2 3 4",), (None,), ("1704067200000 1 2 3 4  ",),
         ("9223372036854775807 1 1 1 1",), ("253402300800000 1 1 1 1",)],
        "value string")
    good = parse_ad_log(lines).collect()
    assert len(good) == 3 and len(set(good)) == 1  # blanks at the end and further fields do no harm
    r = good[0]
    assert (r.ts, r.date, r.province, r.city, r.userid, r.adid) == \
        (dt.datetime(2024, 1, 1), "20240101", "1", "2", 3, 4)
    assert quarantine(lines).count() == 7


def _clicks(spark, user_ad_counts):
    data = []
    for user, ad, n in user_ad_counts:
        data += [(f"{1704067200000 + i} 1 1 {user} {ad}",) for i in range(n)]
    return parse_ad_log(spark.createDataFrame(data, "value string"))


def test_blacklist_threshold(spark):
    clicks = _clicks(spark, [(1, 0, 10), (2, 0, 11), (3, 0, 6), (3, 1, 6)])
    got = rows(ads.blacklist_candidates(ads.user_click_count(clicks)))
    assert got == [(2,)]  # exactly 10 is kept; 6 + 6 on two ads is not one key over 10


def test_blacklist_filter_drops_numeric_ids(spark):
    clicks = _clicks(spark, [(1, 0, 2), (2, 0, 3)])
    bl = spark.createDataFrame([(2,)], AD_BLACKLIST)
    assert rows(ads.clicks_per_user(ads.drop_blacklisted(clicks, bl))) == [(1, 2)]


def test_province_top3_and_trend(spark):
    lines = [(f"{1704067200000 + 1000 * i} p c 1 {ad}",) for i, ad in enumerate([1, 1, 2, 2, 3, 3, 4])]
    clicks = parse_ad_log(spark.createDataFrame(lines, "value string"))
    top = rows(ads.province_top3(ads.province_count(ads.ad_stat(clicks))))
    assert top == [("20240101", "p", 1, 2), ("20240101", "p", 2, 2), ("20240101", "p", 3, 2)]
    assert rows(ads.click_trend(clicks)) == [("20240101", "00", "00", 1, 2), ("20240101", "00", "00", 2, 2),
                                             ("20240101", "00", "00", 3, 2), ("20240101", "00", "00", 4, 1)]


def test_sliding_hour_windows(spark):
    # one click at 00:00 and one at 00:30 -> windows ending 00:01..01:00 hold the first,
    # 00:31..01:30 the second
    lines = [("1704067200000 p c 1 9",), ("1704069000000 p c 1 9",)]
    out = ads.sliding_hour(parse_ad_log(spark.createDataFrame(lines, "value string")))
    got = {r["window_end"]: r["click_count"] for r in out.collect()}
    assert len(got) == 90
    assert got[dt.datetime(2024, 1, 1, 0, 1)] == 1
    assert got[dt.datetime(2024, 1, 1, 0, 31)] == 2
    assert got[dt.datetime(2024, 1, 1, 1, 0)] == 2
    assert got[dt.datetime(2024, 1, 1, 1, 30)] == 1


def test_minutes_do_not_depend_on_the_session_zone(spark):
    from shoplens.operators import ads
    from shoplens.runtime import session_conf
    with session_conf(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        clicks = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:30.5' AS ts, 1L AS adid")  # an hour that zone skips
        assert [tuple(r) for r in ads.click_trend(clicks).collect()] == [("20240310", "02", "30", 1, 1)]


def test_packed_fields_and_sql_functions(spark):
    from shoplens.functions.scalar import field_of_packed, register_sql_functions, set_field_in_packed
    df = spark.createDataFrame([("a=1|a=2|b.c=3",), ("x=1",), (None,)], "t string")
    got = df.select(field_of_packed("t", "a"), set_field_in_packed("t", "b.c", "$9")).collect()
    assert [tuple(r) for r in got] == [("1", "a=1|a=2|b.c=$9"), (None, "x=1"), (None, None)]
    register_sql_functions(spark)
    assert spark.sql("SELECT concat_long_string(7, 'x', ':')").first()[0] == "7:x"

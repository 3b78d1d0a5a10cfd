"""The query catalogue: one Spark plan per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every plan reads the driver's tables through the adapters in ``shoplens.sources.testdata`` and
runs over the whole tables; the matching DuckDB SQL lives in ``shoplens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import scalar
from shoplens.operators import ads, area, category, pageflow, sampling, sessions
from shoplens.params import DEFAULT_SESSION_PARAMS, QUERY_PARAMS, SCAN_PARAMS, TaskParams
from shoplens.plans.tables import Tables
from shoplens.runtime import materialize, shared_dir
from shoplens.schema import AD_BLACKLIST
from shoplens.sources.actions import scan_actions, scan_clicks
from shoplens.sources import testdata
from shoplens.sources.adlog import parse_ad_log, read_ad_log_stream
from shoplens.sources.logfeed import read_log_feed
from shoplens.sources.tables import read_actions, save_actions
from shoplens.streaming import ads as stream_ads
from shoplens.streaming.ads import AdStreamStore
from shoplens.streaming.feed import write_feed

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

AREA_PARAMS = QUERY_PARAMS


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# ---------------------------------------------------------------- scans / area top-3
@query("action_scan")
def q_action_scan(spark, sf_dir):
    return scan_actions(Tables(spark, sf_dir).actions, SCAN_PARAMS)


@query("click_scan")
def q_click_scan(spark, sf_dir):
    return scan_clicks(Tables(spark, sf_dir).actions, SCAN_PARAMS)


def _area_basic(t: Tables) -> DataFrame:
    return area.area_click_basic(scan_clicks(t.actions, AREA_PARAMS), t.cities)


@query("area_click_basic")
def q_area_click_basic(spark, sf_dir):
    return _area_basic(Tables(spark, sf_dir))


@query("area_click_count")
def q_area_click_count(spark, sf_dir):
    return area.area_click_count(_area_basic(Tables(spark, sf_dir)))


@query("group_concat_distinct")
def q_group_concat_distinct(spark, sf_dir):
    return area.area_city_list(_area_basic(Tables(spark, sf_dir)))


def _area_info(t: Tables) -> DataFrame:
    return area.area_product_info(area.area_click_count(_area_basic(t)), t.products)


@query("area_product_info")
def q_area_product_info(spark, sf_dir):
    return _area_info(Tables(spark, sf_dir))


@query("area_top3")
def q_area_top3(spark, sf_dir):
    return area.area_top3(_area_info(Tables(spark, sf_dir)))


@query("area_top3_sql")
def q_area_top3_sql(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return area.area_top3_sql(spark, scan_clicks(t.actions, AREA_PARAMS), t.cities, t.products)


# ---------------------------------------------------------------- sessions
SESSION_PARAMS = DEFAULT_SESSION_PARAMS


def _summary(t: Tables, p: TaskParams = SESSION_PARAMS) -> DataFrame:
    return sessions.session_summary(scan_actions(t.actions, p), p)


def _enriched(t: Tables, p: TaskParams = SESSION_PARAMS) -> DataFrame:
    return sessions.enrich(_summary(t, p), t.users)


def _filtered(t: Tables, p: TaskParams = SESSION_PARAMS) -> DataFrame:
    return sessions.filter_sessions(_enriched(t, p), p)


@query("session_summary")
def q_session_summary(spark, sf_dir):
    return sessions.public(_summary(Tables(spark, sf_dir)))


SESSION_BUCKETS = 16


@query("session_summary_table")
def q_session_summary_table(spark, sf_dir):
    """From a table kept by date and session bucket: its aggregate by session shuffles nothing."""
    path = shared_dir(spark, "user_visit_action")
    name = f"user_visit_action_{path.rsplit('/', 1)[1]}"
    save_actions(Tables(spark, sf_dir).actions, name, SESSION_BUCKETS, path)
    return sessions.public(sessions.session_summary(scan_actions(read_actions(spark, name), SESSION_PARAMS)))


@query("session_enriched")
def q_session_enriched(spark, sf_dir):
    return sessions.public(_enriched(Tables(spark, sf_dir)))


FILTER_AGE = QUERY_PARAMS.with_(start_age=20, end_age=50)
FILTER_IN = QUERY_PARAMS.with_(professionals=tuple(f"professional{i}" for i in range(1, 41)),
                       cities=("city1", "city2", "city3"))
FILTER_SEX = QUERY_PARAMS.with_(sex="male")
FILTER_OVERLAP = QUERY_PARAMS.with_(keywords=("kw1", "kw2"), category_ids=tuple(range(1, 31)))


def _filter_query(p: TaskParams):
    def run(spark, sf_dir):
        return _filtered(Tables(spark, sf_dir), p).select("session_id", "user_id")
    return run


QUERIES["session_filter_age"] = _filter_query(FILTER_AGE)
QUERIES["session_filter_in"] = _filter_query(FILTER_IN)
QUERIES["session_filter_sex"] = _filter_query(FILTER_SEX)
QUERIES["session_filter_overlap"] = _filter_query(FILTER_OVERLAP)


@query("session_filtered")
def q_session_filtered(spark, sf_dir):
    return sessions.public(_filtered(Tables(spark, sf_dir)))


@query("session_histogram")
def q_session_histogram(spark, sf_dir):
    return sessions.length_histogram(_filtered(Tables(spark, sf_dir)))


@query("session_stat_ratio")
def q_session_stat_ratio(spark, sf_dir):
    return sessions.stat_ratio(_filtered(Tables(spark, sf_dir)))


# ---------------------------------------------------------------- sampling
SAMPLE_TOTAL = 300


def _quota(t: Tables) -> DataFrame:
    return sampling.extract_quota(sampling.hour_counts(_filtered(t)), SAMPLE_TOTAL)


def _extracted(t: Tables) -> DataFrame:
    # the filtered sessions feed both the quota and the ranking: materialise them once
    s = materialize(_filtered(t))
    quota = sampling.extract_quota(sampling.hour_counts(s), SAMPLE_TOTAL)
    return sampling.extract_sessions(s, quota, SAMPLE_TOTAL)


@query("session_hour_count")
def q_session_hour_count(spark, sf_dir):
    return sampling.hour_counts(_filtered(Tables(spark, sf_dir)))


@query("session_extract_quota")
def q_session_extract_quota(spark, sf_dir):
    return _quota(Tables(spark, sf_dir))


@query("session_extract")
def q_session_extract(spark, sf_dir):
    return _extracted(Tables(spark, sf_dir))


@query("session_extract_detail")
def q_session_extract_detail(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sampling.extract_detail(scan_actions(t.actions, SESSION_PARAMS), _extracted(t), SAMPLE_TOTAL)


# ---------------------------------------------------------------- categories
def _fa(t: Tables) -> DataFrame:
    return category.actions_of_qualifying_sessions(scan_actions(t.actions, SESSION_PARAMS), t.users,
                                                   SESSION_PARAMS)


@query("filtered_actions")
def q_filtered_actions(spark, sf_dir):
    return _fa(Tables(spark, sf_dir)).select(*category.FILTERED_ACTION_COLUMNS)


@query("category_click_count")
def q_category_click_count(spark, sf_dir):
    return category.click_counts(_fa(Tables(spark, sf_dir)))


@query("category_order_count")
def q_category_order_count(spark, sf_dir):
    return category.order_counts(_fa(Tables(spark, sf_dir)))


@query("category_pay_count")
def q_category_pay_count(spark, sf_dir):
    return category.pay_counts(_fa(Tables(spark, sf_dir)))


@query("active_categories")
def q_active_categories(spark, sf_dir):
    return category.active_categories(_fa(Tables(spark, sf_dir)))


@query("category_funnel")
def q_category_funnel(spark, sf_dir):
    return category.category_funnel(_fa(Tables(spark, sf_dir)))


def _top10(fa: DataFrame) -> DataFrame:
    return category.top_categories(category.category_funnel(fa), 10)


@query("top10_category")
def q_top10_category(spark, sf_dir):
    return _top10(_fa(Tables(spark, sf_dir)))


def _top_category_clicks(t: Tables) -> DataFrame:
    # one aggregation of the filtered actions per (category, session), materialised once, feeds
    # both the funnel (for the top 10) and the per-session clicks: the actions are scanned once
    skc = materialize(category.session_kind_counts(_fa(t)))
    top = category.top_categories(category.funnel_from_session_counts(skc), 10)
    return category.clicks_of_top(skc, top)


@query("session_category_count")
def q_session_category_count(spark, sf_dir):
    return _top_category_clicks(Tables(spark, sf_dir))


@query("top_sessions_per_category")
def q_top_sessions_per_category(spark, sf_dir):
    return category.top_sessions(_top_category_clicks(Tables(spark, sf_dir)), 10)


# ---------------------------------------------------------------- page flow
PAGE_PARAMS = QUERY_PARAMS


def _page_actions(t: Tables) -> DataFrame:
    return scan_actions(t.actions, PAGE_PARAMS)


@query("page_pairs")
def q_page_pairs(spark, sf_dir):
    return pageflow.page_pairs(_page_actions(Tables(spark, sf_dir)))


@query("page_pair_count")
def q_page_pair_count(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return pageflow.page_pair_counts(pageflow.page_pairs(_page_actions(t)), PAGE_PARAMS.target_page_flow)


@query("page_start_count")
def q_page_start_count(spark, sf_dir):
    return pageflow.start_page_count(_page_actions(Tables(spark, sf_dir)), PAGE_PARAMS.target_page_flow)


@query("page_convert_rate")
def q_page_convert_rate(spark, sf_dir):
    flow = PAGE_PARAMS.target_page_flow
    pairs, start = pageflow.flow_counts(_page_actions(Tables(spark, sf_dir)), flow)
    return pageflow.convert_rate(spark, pairs, start, flow)


# ---------------------------------------------------------------- advertisement clicks (batch)
def _clicks(t: Tables) -> DataFrame:
    return parse_ad_log(t.ad_log)


@query("ad_log_parsed")
def q_ad_log_parsed(spark, sf_dir):
    return _clicks(Tables(spark, sf_dir))


FIXED_BLACKLIST = (0,)


@query("ad_blacklist_filter")
def q_ad_blacklist_filter(spark, sf_dir):
    blacklist = spark.createDataFrame([(u,) for u in FIXED_BLACKLIST], AD_BLACKLIST)
    # counted first: what is joined is one row per user, not the log
    return ads.drop_blacklisted(ads.clicks_per_user(_clicks(Tables(spark, sf_dir))), blacklist).select("userid", "cnt")


@query("ad_user_click_count")
def q_ad_user_click_count(spark, sf_dir):
    return ads.user_click_count(_clicks(Tables(spark, sf_dir)))


@query("ad_blacklist")
def q_ad_blacklist(spark, sf_dir):
    return ads.blacklist_candidates(ads.user_click_count(_clicks(Tables(spark, sf_dir))))


@query("ad_stat")
def q_ad_stat(spark, sf_dir):
    return ads.ad_stat(_clicks(Tables(spark, sf_dir)))


@query("ad_province_count")
def q_ad_province_count(spark, sf_dir):
    return ads.province_count(ads.ad_stat(_clicks(Tables(spark, sf_dir))))


@query("ad_province_top3")
def q_ad_province_top3(spark, sf_dir):
    return ads.province_top3(ads.province_count(ads.ad_stat(_clicks(Tables(spark, sf_dir)))))


@query("ad_click_trend")
def q_ad_click_trend(spark, sf_dir):
    return ads.click_trend(_clicks(Tables(spark, sf_dir)))


@query("ad_recent_hour")
def q_ad_recent_hour(spark, sf_dir):
    return ads.recent_hour(_clicks(Tables(spark, sf_dir)))


@query("ad_sliding_hour")
def q_ad_sliding_hour(spark, sf_dir):
    return ads.sliding_hour(_clicks(Tables(spark, sf_dir)))


# ---------------------------------------------------------------- keyed sinks (two batches)
def _parity_clicks(t: Tables):
    lines = testdata.ad_log(t.spark, t.sf_dir, keep_event_id=True)
    even = parse_ad_log(lines.where(F.col("event_id") % 2 == 0).select("value"))
    odd = parse_ad_log(lines.where(F.col("event_id") % 2 == 1).select("value"))
    return even, odd


def _apply_two(spark, sf_dir, sink_name: str, make_rows, mode: str | None = None) -> DataFrame:
    t = Tables(spark, sf_dir)
    store = AdStreamStore(spark, shared_dir(spark, "upsert"))
    sink = store.sink(sink_name, mode)
    for batch_id, clicks in enumerate(_parity_clicks(t)):
        sink.apply(make_rows(clicks), batch_id)
    return sink.snapshot()


@query("upsert_replace")
def q_upsert_replace(spark, sf_dir):
    return _apply_two(spark, sf_dir, "ad_stat", ads.ad_stat, "replace")


@query("upsert_add")
def q_upsert_add(spark, sf_dir):
    return _apply_two(spark, sf_dir, "ad_user_click_count", ads.user_click_count)


@query("upsert_replace_group")
def q_upsert_replace_group(spark, sf_dir):
    return _apply_two(spark, sf_dir, "ad_province_top3",
                      lambda c: ads.province_top3(ads.province_count(ads.ad_stat(c))))


# ---------------------------------------------------------------- streaming forms
STREAM_FEED_FILES = 4
AVAILABLE_NOW = {"availableNow": True}


def _run_stream(spark, sf_dir, job: str, blacklist: tuple[int, ...] = ()) -> AdStreamStore:
    """Feed the ad log through the clean-clicks query (from ``blacklist`` on) and then ``job``; return the store."""
    store = AdStreamStore(spark, shared_dir(spark, "ad-stream"))
    if blacklist:
        store.seed_blacklist(spark.createDataFrame([(u,) for u in blacklist], AD_BLACKLIST))
    write_feed(Tables(spark, sf_dir).ad_log, store.path("feed"), STREAM_FEED_FILES)
    lines = read_ad_log_stream(spark, store.path("feed"), max_files_per_trigger=2)
    stream_ads.start_clean_clicks(lines, store, AVAILABLE_NOW).awaitTermination()
    clicks = stream_ads.clean_clicks(store, max_files_per_trigger=1)
    start = {"stat": stream_ads.start_ad_stat, "trend": stream_ads.start_click_trend, "blacklist": stream_ads.start_blacklist}
    if job not in start:
        return store
    q = start[job](clicks, store, trigger=AVAILABLE_NOW)
    q.awaitTermination()
    return store


@query("ad_stat_stream")
def q_ad_stat_stream(spark, sf_dir):
    return _run_stream(spark, sf_dir, "stat").sink("ad_stat").snapshot()


@query("ad_province_top3_stream")
def q_ad_province_top3_stream(spark, sf_dir):
    return _run_stream(spark, sf_dir, "stat").sink("ad_province_top3").snapshot()


@query("ad_click_trend_stream")
def q_ad_click_trend_stream(spark, sf_dir):
    return _run_stream(spark, sf_dir, "trend").sink("ad_click_trend").snapshot()


@query("ad_blacklist_stream")
def q_ad_blacklist_stream(spark, sf_dir):
    return _run_stream(spark, sf_dir, "blacklist").sink("ad_blacklist").snapshot()


@query("ad_log_parsed_stream")
def q_ad_log_parsed_stream(spark, sf_dir):
    """Through the source that keeps its own offsets, into a file sink with its commit log."""
    store = AdStreamStore(spark, shared_dir(spark, "ad-log"))
    write_feed(Tables(spark, sf_dir).ad_log, store.path("feed"), STREAM_FEED_FILES)
    lines = read_log_feed(spark, store.path("feed"), range_bytes=8 << 20).select("value")
    (parse_ad_log(lines).writeStream.format("parquet").option("checkpointLocation", store.checkpoint("log"))
     .trigger(**AVAILABLE_NOW).start(store.path("parsed")).awaitTermination())
    return spark.read.parquet(store.path("parsed"))


@query("ad_blacklist_filter_stream")
def q_ad_blacklist_filter_stream(spark, sf_dir):
    store = _run_stream(spark, sf_dir, "clean", FIXED_BLACKLIST)
    return ads.clicks_per_user(spark.read.parquet(store.clean_path))


# ---------------------------------------------------------------- scalar functions
@query("scalar_functions")
def q_scalar_functions(spark, sf_dir):
    return scalar.scalar_showcase(Tables(spark, sf_dir).raw("events"))


@query("page_convert_rate_text")
def q_page_convert_rate_text(spark, sf_dir):
    return pageflow.render_rates(q_page_convert_rate(spark, sf_dir))

"""The four applications, each producing all of its result tables in one run.

``session_job``  session_stat_ratio, session_extract, session_detail, top10_category, top10_session
``page_job``     page_split_convert_rate (one row per step plus the rendered string)
``area_job``     area_top3_product
``ad_stream_job``  starts the four streaming queries of ``shoplens.streaming.ads``

Inputs are DataFrames (tables in production, the adapters in tests) and a ``TaskParams``. The
filtered session table and the per-(category, session) counts feed several results each, so they
are persisted for the run and released in ``finally``; results are written with a ``task_id``
column through ``write_results``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from shoplens.operators import area, category, pageflow, sampling, sessions
from shoplens.params import TaskParams
from shoplens.sinks.jdbc import append_jdbc, with_task_id
from shoplens.sources.actions import scan_actions, scan_clicks
from shoplens.streaming import ads as stream_ads


@dataclass
class ShopTables:
    actions: DataFrame
    users: DataFrame | None = None
    products: DataFrame | None = None
    cities: DataFrame | None = None


def session_results(t: ShopTables, p: TaskParams, sample_total: int = sampling.DEFAULT_TOTAL,
                    seed: int = sampling.DEFAULT_SEED) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Lazy result DataFrames of the session job and the shared intermediates (filtered
    sessions, per-(category, session) counts) that the caller persists while writing."""
    acts = scan_actions(t.actions, p)
    filtered = sessions.filter_sessions(sessions.enrich(sessions.session_summary(acts, p), t.users), p)
    fa = category.actions_of_qualifying_sessions(acts, t.users, p, filtered)
    skc = category.session_kind_counts(fa)  # persisted by the runner: feeds funnel and clicks
    top10 = category.top_categories(category.funnel_from_session_counts(skc), 10)
    quota = sampling.extract_quota(sampling.hour_counts(filtered), sample_total)
    extracted = sampling.extract_sessions(filtered, quota, sample_total, seed)
    results = {
        "session_stat_ratio": sessions.stat_ratio(filtered),
        "session_extract": extracted,
        "session_detail": sampling.extract_detail(acts, extracted, sample_total),
        "top10_category": top10,
        "top10_session": category.top_sessions(category.clicks_of_top(skc, top10), 10),
    }
    return results, [filtered, skc]


def page_results(t: ShopTables, p: TaskParams) -> dict[str, DataFrame]:
    acts = scan_actions(t.actions, p)
    flow = p.target_page_flow
    if not flow:
        raise ValueError("the page job needs a targetPageFlow")
    pairs, start = pageflow.flow_counts(acts, flow)
    rates = pageflow.convert_rate(acts.sparkSession, pairs, start, flow)
    return {"page_split_convert_rate": rates, "page_split_convert_rate_text": pageflow.render_rates(rates)}


def area_results(t: ShopTables, p: TaskParams) -> dict[str, DataFrame]:
    basic = area.area_click_basic(scan_clicks(t.actions, p), t.cities)
    info = area.area_product_info(area.area_click_count(basic), t.products)
    return {"area_top3_product": area.area_top3(info)}


Writer = Callable[[DataFrame, str], None]


def to_files(out_dir: str, task_id: str) -> Writer:
    """Results under ``out_dir/<name>/task_id=<id>`` (rerunning a task replaces its own rows only)."""
    def write(df: DataFrame, name: str) -> None:
        with_task_id(df, task_id).write.mode("overwrite").partitionBy("task_id") \
            .option("partitionOverwriteMode", "dynamic").parquet(f"{out_dir}/{name}")
    return write


def to_jdbc(url: str, task_id: str, properties: dict | None = None) -> Writer:
    """Results appended to database tables of their names, with the task id as a column."""
    return lambda df, name: append_jdbc(with_task_id(df, task_id), url, name, properties)


def write_results(results: dict[str, DataFrame], write: Writer) -> None:
    for name, df in results.items():
        write(df, name)


def run_session_job(t: ShopTables, p: TaskParams, out: str | Writer, task_id: str,
                    sample_total: int = sampling.DEFAULT_TOTAL) -> None:
    results, shared = session_results(t, p, sample_total)
    for df in shared:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_results(results, _writer(out, task_id))
    finally:
        for df in shared:
            df.unpersist()


def run_page_job(t: ShopTables, p: TaskParams, out: str | Writer, task_id: str) -> None:
    results = page_results(t, p)
    rates = results["page_split_convert_rate"].persist()  # a row per step: the text is made of them
    try:
        write_results({**results, "page_split_convert_rate_text": pageflow.render_rates(rates)}, _writer(out, task_id))
    finally:
        rates.unpersist()


def run_area_job(t: ShopTables, p: TaskParams, out: str | Writer, task_id: str) -> None:
    write_results(area_results(t, p), _writer(out, task_id))


def _writer(out: str | Writer, task_id: str) -> Writer:
    return to_files(out, task_id) if isinstance(out, str) else out


def start_ad_stream_job(spark: SparkSession, lines: DataFrame, root: str,
                        watermark: str | None = stream_ads.DEFAULT_WATERMARK,
                        trigger: dict | None = None, with_blacklist: bool = True, zone: str = "UTC",
                        in_turn: bool = False):
    """Start clean -> (stat + top 3, trend, blacklist) over the log stream ``lines``; days and hours are those of ``zone``.
    ``in_turn``: the readers start when the first query has ended (for a trigger that ends)."""
    store = stream_ads.AdStreamStore(spark, root)
    queries = [stream_ads.start_clean_clicks(lines, store, trigger, zone)]
    if in_turn:
        queries[0].awaitTermination()
    queries.append(stream_ads.start_ad_stat(stream_ads.clean_clicks(store), store, watermark, trigger))
    queries.append(stream_ads.start_click_trend(stream_ads.clean_clicks(store), store, watermark, trigger))
    if with_blacklist:
        queries.append(stream_ads.start_blacklist(stream_ads.clean_clicks(store), store, trigger=trigger))
    return store, queries

"""Page-to-page conversion along a target page flow.

Consecutive page pairs per session come from ``shoplens.operators.ordered``: sessions are shuffled whole, but a hot
one in pieces of its time order, so no task has to hold a session, or an hour of one, however large it grows.
Rows are ordered by (action_time, page_id); rows tied on both are interchangeable, so the page sequence is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.functions.scalar import half_up_ratio
from shoplens.operators.ordered import followers


def consecutive_pairs(df: DataFrame, key: str, time_col: str, value: str, tasks: int | None = None) -> DataFrame:
    """(key, value, next_value) for every pair of consecutive rows of a key ordered by
    (time_col, value)."""
    rows, across = followers(df.select(key, time_col, value), key, [time_col, value], value, tasks)
    return rows.where("_followed").select(key, value, F.col("_next").alias(f"next_{value}")).unionByName(across)


def flow_counts(actions: DataFrame, flow: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """(pair counts, start-page count) from one pass: the start-page rows are counted from the
    same rows the pairs come from, so both share one shuffle of the actions."""
    rows, across = followers(actions.select("session_id", "action_time", "page_id"), "session_id",
                             ["action_time", "page_id"], "page_id")
    start = int(flow[0])
    wanted = [p for _, p in target_pairs(flow)] + ["start"]
    # every row yields its pair and, on the start page, a 'start' label
    row_labels = rows.select(F.explode(F.array(
        F.when(F.col("_followed"), page_pair_key("page_id", "_next")),
        F.when(F.col("page_id") == start, F.lit("start")))).alias("label"))
    cross_labels = across.select(page_pair_key().alias("label"))
    labels = row_labels.unionByName(cross_labels).where(F.col("label").isin(wanted))
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("cnt"))
    pairs = counts.where(F.col("label") != "start").select(F.col("label").alias("page_pair"), "cnt")
    start_count = (counts.where(F.col("label") == "start")
                   .select(F.lit(start).cast("bigint").alias("start_page"), "cnt"))
    return pairs, start_count


def page_pairs(actions: DataFrame, tasks: int | None = None) -> DataFrame:
    """(session_id, page_id, next_page_id)."""
    return consecutive_pairs(actions, "session_id", "action_time", "page_id", tasks)


def target_pairs(flow: Sequence[int]) -> list[tuple[int, str]]:
    """(step, 'p1_p2') for each consecutive pair of the target flow."""
    flow = [int(p) for p in flow]
    return [(i + 1, f"{a}_{b}") for i, (a, b) in enumerate(zip(flow, flow[1:]))]


def page_pair_key(a="page_id", b="next_page_id"):
    return F.concat_ws("_", F.col(a).cast("string"), F.col(b).cast("string"))


def page_pair_counts(pairs: DataFrame, flow: Sequence[int]) -> DataFrame:
    """(page_pair, cnt) for the pairs of the target flow that occur."""
    wanted = [p for _, p in target_pairs(flow)]
    return (pairs.select(page_pair_key().alias("page_pair"))
            .where(F.col("page_pair").isin(wanted))
            .groupBy("page_pair").agg(F.count(F.lit(1)).alias("cnt")))


def start_page_count(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """(start_page, cnt) -- page views (rows) of the flow's first page."""
    start = int(flow[0])
    return (actions.where(F.col("page_id") == start)
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.lit(start).cast("bigint").alias("start_page"), "cnt"))


def convert_rate(spark: SparkSession, pair_counts: DataFrame, start_count: DataFrame,
                 flow: Sequence[int]) -> DataFrame:
    """(step, page_pair, cnt, prev_cnt, rate); an unseen pair counts 0, rate is null when
    the previous count is 0. The steps table has one row per flow step (a parameter)."""
    steps = spark.createDataFrame(target_pairs(flow), "step int, page_pair string")
    counted = (steps.join(F.broadcast(pair_counts), "page_pair", "left")
               .select("step", "page_pair", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")))
    # the start count is one row; with no start-page rows at all it counts 0
    step0 = (spark.createDataFrame([(0,)], "step int")
             .join(F.broadcast(start_count.select(F.lit(0).alias("step"), "cnt")), "step", "left")
             .select("step", F.lit(None).cast("string").alias("page_pair"),
                     F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")))
    # One row per step of the flow: a bounded, single-partition window.
    w = Window.orderBy("step")
    chained = counted.unionByName(step0).withColumn("prev_cnt", F.lag("cnt").over(w))
    return (chained.where(F.col("step") > 0)
            .select("step", "page_pair", "cnt", "prev_cnt",
                    half_up_ratio("cnt", "prev_cnt").alias("rate")))


def render_rates(rates: DataFrame) -> DataFrame:
    """The rates as one 'p1_p2=r|p2_p3=r' string in step order."""
    item = F.struct("step", F.concat_ws("=", "page_pair", F.col("rate").cast("string")).alias("kv"))
    return rates.agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["kv"]),
                                  "|").alias("convert_rate"))

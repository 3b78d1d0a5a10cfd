"""Stratified, reproducible session sample: a day quota spread over hours by their share.

day_quota = total div days; quota(date, hour) = least(cnt, cnt * day_quota div day_cnt), all in
exact integers. The sample of a (date, hour) is its first ``quota`` sessions in the order of
``md5(session_id || '-' || seed)`` -- a seeded pseudo-random order that any engine reproduces.

No hour is ranked as a whole. The hashes are uniform, so an hour of ``cnt`` sessions is cut into cells of about
``CELL`` sessions by the leading bits; exact counts per cell, summed in order, tell the cell that the quota ends in. Sessions of
earlier cells are taken, later ones are not, and only within cells -- of some hundred rows, whatever the hour and the
``total`` -- are sessions ranked. The quota table and the bounds have one row per (date, hour), 24 a day, and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.scalar import format_date, int_div

DEFAULT_TOTAL = 100
DEFAULT_SEED = 42


def with_date_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("date", format_date("start_time")) \
        .withColumn("hour", F.date_format("start_time", "HH"))


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (start date, start hour)."""
    return with_date_hour(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("cnt"))


def extract_quota(hours: DataFrame, total: int = DEFAULT_TOTAL) -> DataFrame:
    """Per-hour quota over the (date, hour) count table (at most 24 rows per day of the
    task's range). The number of days is a scalar subquery; the day total a window per date."""
    days = hours.select(F.count_distinct("date")).scalar()
    out = (hours.withColumn("day_cnt", F.sum("cnt").over(Window.partitionBy("date")))
           .withColumn("day_quota", int_div(F.lit(int(total)), days)))
    quota = F.least(F.col("cnt"), int_div(F.col("cnt") * F.col("day_quota"), F.col("day_cnt")))
    return out.select("date", "hour", "cnt", "day_cnt", quota.alias("quota"))


#: Sessions of a cell, about.
CELL = 500
#: A sample of up to so many sessions is broadcast to find its actions.
BROADCAST_SAMPLE = 100_000


def sample_hash(seed: int = DEFAULT_SEED):
    return F.md5(F.concat(F.col("session_id"), F.lit(f"-{int(seed)}")))


def in_cells(sessions: DataFrame, quotas: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """The sessions of hours with a quota, with date, hour, quota, _hash and _cell (0, 1, ... in the order of the hashes)."""
    wanted = quotas.where("quota > 0").select("date", "hour", "quota", F.ceil(F.col("cnt") / CELL).cast("bigint").alias("_cells"))
    s = with_date_hour(sessions).join(F.broadcast(wanted), ["date", "hour"]).withColumn("_hash", sample_hash(seed))
    leading = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")  # 32 bits
    return s.withColumn("_cell", F.shiftright(leading * F.col("_cells"), 32)).drop("_cells")


def extract_sessions(sessions: DataFrame, quotas: DataFrame, total: int = DEFAULT_TOTAL,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """The sampled sessions (session_id, start_time, search_keywords, click_category_ids) of a quota table made for
    ``total``."""
    s = in_cells(sessions, quotas, seed)
    along = Window.partitionBy("date", "hour").orderBy("_cell")  # a row per cell
    cells = s.groupBy("date", "hour", "quota", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.withColumn("_before", F.sum("_n").over(along) - F.col("_n"))
    ends = cells.where((F.col("_before") < F.col("quota")) & (F.col("_before") + F.col("_n") >= F.col("quota"))) \
        .select("date", "hour", F.col("_cell").alias("_last"), (F.col("quota") - F.col("_before")).alias("_of_last"))
    near = s.join(F.broadcast(ends), ["date", "hour"]).where("_cell <= _last")
    w = Window.partitionBy("date", "hour", "_cell").orderBy("_hash", "session_id")
    picked = near.withColumn("_rn", F.row_number().over(w)).where((F.col("_cell") < F.col("_last")) | (F.col("_rn") <= F.col("_of_last")))
    return picked.select("session_id", "start_time", "search_keywords", "click_category_ids")


DETAIL_COLUMNS = ["session_id", "user_id", "page_id", "action_time", "search_keyword",
                  "click_category_id", "click_product_id", "order_category_ids",
                  "order_product_ids", "pay_category_ids", "pay_product_ids"]


def extract_detail(actions: DataFrame, extracted: DataFrame, total: int = DEFAULT_TOTAL) -> DataFrame:
    """Q26: every action of the sampled sessions. The sample holds at most ``total`` sessions (a parameter): up to
    ``BROADCAST_SAMPLE`` their ids are broadcast and the actions are not shuffled."""
    ids = extracted.select("session_id")
    ids = F.broadcast(ids) if total <= BROADCAST_SAMPLE else ids
    return actions.join(ids, "session_id", "left_semi").select(*DETAIL_COLUMNS)

"""Advertisement click statistics on parsed clicks (ts, date, province, city, userid, adid).

These are the batch forms; ``shoplens.streaming.ads`` runs the same transformations per
micro-batch or as stateful streaming aggregations. All counts are partial + final hash
aggregates, so the hot (user, ad) keys of a click flood are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.scalar import format_date_key, pad2
from shoplens.operators.topk import top_k_per_group
from shoplens.runtime import materialize

BLACKLIST_THRESHOLD = 10


def drop_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not on the blacklist (anti join on the numeric user id; the
    blacklist grows with the user base, so the join strategy is left to AQE)."""
    return clicks.join(blacklist.select("userid").distinct(), "userid", "left_anti")


def clicks_per_user(clicks: DataFrame) -> DataFrame:
    """(userid, cnt) -- what survives the blacklist, per user."""
    return clicks.groupBy("userid").agg(F.count(F.lit(1)).alias("cnt"))


def user_click_count(clicks: DataFrame) -> DataFrame:
    """(date, userid, adid, click_count)."""
    return clicks.groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("click_count"))


def blacklist_candidates(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users with more than ``threshold`` clicks on one ad in one day."""
    return counts.where(F.col("click_count") > F.lit(threshold)).select("userid").distinct()


def ad_stat(clicks: DataFrame) -> DataFrame:
    """I4 (batch form): (date, province, city, adid, click_count)."""
    return clicks.groupBy("date", "province", "city", "adid") \
        .agg(F.count(F.lit(1)).alias("click_count"))


def province_count(stat: DataFrame) -> DataFrame:
    """Roll the city counts up to provinces."""
    return stat.groupBy("date", "province", "adid") \
        .agg(F.sum("click_count").cast("bigint").alias("click_count"))


def province_top3(pc: DataFrame, k: int = 3) -> DataFrame:
    """The k most clicked ads per (date, province), ties by adid."""
    return top_k_per_group(pc, ["date", "province"],
                           [F.col("click_count").desc(), F.col("adid").asc()], k) \
        .select("date", "province", "adid", "click_count")


def minute_of(ts="ts"):
    """The event minute as TIMESTAMP_NTZ: the seconds are taken off the wall clock, so the session time
    zone and its clock changes have no part in it (``date_trunc`` goes through a zoned TIMESTAMP)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", -(F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"), ts)


def trend_columns(minute_col: str = "minute_ts") -> list:
    m = F.col(minute_col)
    return [format_date_key(m).alias("date"), pad2(F.hour(m)).alias("hour"), pad2(F.minute(m)).alias("minute")]


def click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per (event minute, ad) as (date, hour, minute, adid, click_count)."""
    return per_minute(clicks).select(*trend_columns(), "adid", F.col("n").alias("click_count"))


def per_minute(clicks: DataFrame) -> DataFrame:
    """Clicks per (event minute, ad): minute_ts, adid, n."""
    return clicks.groupBy(minute_of("ts").alias("minute_ts"), "adid").agg(F.count(F.lit(1)).alias("n"))


def recent_hour(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """The per-minute trend for the ``minutes`` minutes ending at the newest event minute.

    The log is read once: its counts per (minute, ad) are written down, and both the newest minute (a scalar
    subquery) and the last hour are taken from them.
    """
    counts = materialize(per_minute(clicks))
    since = F.timestamp_add("MINUTE", F.lit(-(minutes - 1)), counts.select(F.max("minute_ts")).scalar())
    return counts.where(F.col("minute_ts") >= since).select(*trend_columns(), "adid", F.col("n").alias("click_count"))


#: Minutes of window starts, at least, whose running sum is one group.
SUM_RANGE = 1440


def sliding_hour(clicks: DataFrame, window_minutes: int = 60, slide_minutes: int = 1) -> DataFrame:
    """I5 (sliding form): clicks per (window_end, adid) over ``window_minutes`` windows sliding
    by ``slide_minutes``, for windows with clicks.

    A minute's count is added at the first window that holds the minute and taken off after the last: two
    signed rows a (minute, ad), three where the windows reach into the next range of ``SUM_RANGE`` minutes, which then opens with
    the count. The rows of an (ad, range) thus need no other range, and one running sum over its
    changes gives the totals, which hold until the next change. Only the result has a row per window.
    """
    width, slide = int(window_minutes), int(slide_minutes)
    span = -(-max(SUM_RANGE, width + slide) // slide) * slide  # a window's minutes reach over one border at most
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    minute = F.timestamp_diff("MINUTE", epoch, F.col("minute_ts"))
    floor = lambda x, to: x - F.pmod(x, F.lit(to))
    counts = per_minute(clicks).select("adid", "n", (floor(minute - width, slide) + slide).alias("a"), (floor(minute, slide) + slide).alias("z"))
    counts = counts.where("a < z")  # a slide longer than the window leaves minutes out
    # windows start at a, ..., z - slide: +n at a, -n at z; a range cut by them (one, as a window is shorter) opens with n
    cut = floor(F.col("z"), span)
    inside = (cut <= F.col("a")) | (cut == F.col("z"))
    row = lambda at, n: F.struct(at.alias("start"), n.alias("n"))
    none = F.struct(F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("n"))
    ends = F.when(cut == F.col("z"), none).otherwise(row(F.col("z"), -F.col("n")))
    signed = counts.select("adid", F.inline(F.array(row(F.col("a"), F.col("n")), ends, F.when(inside, none).otherwise(row(cut, F.col("n"))))))
    changes = (signed.where("start IS NOT NULL").groupBy("adid", floor(F.col("start"), span).alias("span"), "start").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("adid", "span").orderBy("start")
    totals = changes.select("adid", "start", F.sum("n").over(order).alias("click_count"),
                            F.coalesce(F.lead("start").over(order), F.col("span") + span).alias("until"))
    held = totals.where("click_count > 0").select(
        "adid", "click_count", F.explode(F.sequence(F.col("start"), F.col("until") - slide, F.lit(slide).cast("bigint"))).alias("start"))
    return held.select(F.timestamp_add("MINUTE", F.col("start") + width, epoch).alias("window_end"), "adid",
                       F.col("click_count").cast("bigint").alias("click_count"))

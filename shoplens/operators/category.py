"""Category popularity over the actions of the filtered sessions.

The click/order/pay funnel is one exploded aggregation instead of three reductions and three
outer joins: every action emits (category, is_click, is_order, is_pay) rows and a single
partial + final hash aggregate sums them, so a hot category is combined map-side. The global
top 10 is ``TakeOrderedAndProject`` (k rows per task); the top-10 category ids are a ten-row
broadcast for the semi join; the per-category top sessions use a partial ``WindowGroupLimit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.scalar import ids_array
from shoplens.operators.sessions import (enrich, filter_sessions, has_session_constraints, one_user_each,
                                         session_summary, user_predicate)
from shoplens.operators.topk import top_k, top_k_per_group
from shoplens.params import TaskParams

FILTERED_ACTION_COLUMNS = ["session_id", "action_time", "page_id", "click_category_id",
                           "order_category_ids", "pay_category_ids"]


def filtered_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the sessions that passed the filters (left semi join on session_id)."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def actions_of_qualifying_sessions(actions: DataFrame, users: DataFrame, p: TaskParams,
                                   filtered_sessions=None, one_user: bool | None = None) -> DataFrame:
    """C2 with the cheapest plan that the data allow; the rule is one: a session qualifies by its own user (the
    smallest id among its actions) and its own keywords and categories, and all its actions count.

    When every constraint is a user attribute (age, profession, city, sex -- the usual case) and one aggregate proves
    that no session has two users (``one_user`` if known), a session qualifies exactly when its user does:
    the actions are semi-joined to the qualifying users and are not shuffled by session. Else the
    session path is taken (``filtered_sessions``, built on demand).
    """
    if not has_session_constraints(p) and (one_user_each(actions) if one_user is None else one_user):
        cond = user_predicate(p)
        u = users if cond is None else users.where(cond)
        return actions.join(u.select("user_id"), "user_id", "left_semi")
    if filtered_sessions is None:
        filtered_sessions = filter_sessions(enrich(session_summary(actions, p), users), p)
    return filtered_actions(actions, filtered_sessions)


def click_counts(fa: DataFrame) -> DataFrame:
    """D5."""
    return (fa.where(F.col("click_category_id") != -1)
            .groupBy(F.col("click_category_id").alias("category_id"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def _list_counts(fa: DataFrame, col: str) -> DataFrame:
    return (fa.where(F.col(col).isNotNull())
            .select(F.explode(ids_array(col)).alias("category_id"))
            .groupBy("category_id").agg(F.count(F.lit(1)).alias("cnt")))


def order_counts(fa: DataFrame) -> DataFrame:
    """D6/B18."""
    return _list_counts(fa, "order_category_ids")


def pay_counts(fa: DataFrame) -> DataFrame:
    """D7/B18."""
    return _list_counts(fa, "pay_category_ids")


CLICK, ORDER, PAY = 1, 2, 3


def _kind_rows(fa: DataFrame, *extra: str) -> DataFrame:
    """(category_id, kind, *extra) with one row per click, ordered id and paid id.

    Built from array concatenation, ``array_repeat`` and ``arrays_zip`` (no lambdas), then one
    ``inline`` generator.
    """
    empty = F.array().cast("array<bigint>")
    click = F.when(F.col("click_category_id") != -1, F.array(F.col("click_category_id"))).otherwise(empty)
    order = F.coalesce(ids_array("order_category_ids"), empty)
    pay = F.coalesce(ids_array("pay_category_ids"), empty)
    cats = F.concat(click, order, pay)
    kinds = F.concat(F.array_repeat(F.lit(CLICK), F.size(click)), F.array_repeat(F.lit(ORDER), F.size(order)),
                     F.array_repeat(F.lit(PAY), F.size(pay)))
    zipped = F.arrays_zip(cats.alias("category_id"), kinds.alias("kind"))
    return fa.select(*extra, F.inline(zipped)).toDF(*extra, "category_id", "kind")


def active_categories(fa: DataFrame) -> DataFrame:
    """Every category clicked, ordered or paid (distinct)."""
    return _kind_rows(fa).select("category_id").distinct()


def category_funnel(fa: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count), zeros where absent."""
    kind = F.col("kind")
    return _kind_rows(fa).groupBy("category_id").agg(
        F.count_if(kind == CLICK).alias("click_count"),
        F.count_if(kind == ORDER).alias("order_count"),
        F.count_if(kind == PAY).alias("pay_count"))


def session_kind_counts(fa: DataFrame) -> DataFrame:
    """(category_id, session_id, click_count, order_count, pay_count): one aggregation of the
    filtered actions that both the funnel and the per-session clicks can be derived from."""
    kind = F.col("kind")
    return _kind_rows(fa, "session_id").groupBy("category_id", "session_id").agg(
        F.count_if(kind == CLICK).alias("click_count"),
        F.count_if(kind == ORDER).alias("order_count"),
        F.count_if(kind == PAY).alias("pay_count"))


def funnel_from_session_counts(skc: DataFrame) -> DataFrame:
    """C3/D9 from ``session_kind_counts``."""
    return skc.groupBy("category_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("click_count", "order_count", "pay_count")])


def clicks_of_top(skc: DataFrame, top: DataFrame) -> DataFrame:
    """D10 from ``session_kind_counts``: sessions that clicked a top category (ten-row broadcast)."""
    return (skc.join(F.broadcast(top.select("category_id")), "category_id", "left_semi")
            .where(F.col("click_count") > 0).select("category_id", "session_id", "click_count"))


def funnel_order():
    return [F.col("click_count").desc(), F.col("order_count").desc(),
            F.col("pay_count").desc(), F.col("category_id").asc()]


def top_categories(funnel: DataFrame, k: int = 10) -> DataFrame:
    """the k categories with most clicks, then orders, then pays (ties by id)."""
    return top_k(funnel, funnel_order(), k)


def session_category_clicks(fa: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per (top category, session). ``top`` has at most k rows: broadcast."""
    ids = F.broadcast(top.select(F.col("category_id").alias("click_category_id")))
    return (fa.join(ids, "click_category_id", "left_semi")
            .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k sessions with most clicks per category (ties by session_id)."""
    return top_k_per_group(counts, ["category_id"],
                           [F.col("click_count").desc(), F.col("session_id").asc()], k)

"""Edge fixtures for category funnel/top-k and page flow."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from shoplens.operators import category, ordered, pageflow

FA_SCHEMA = ("session_id string, action_time timestamp_ntz, page_id bigint, click_category_id bigint, "
             "order_category_ids string, pay_category_ids string")
T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def fa(spark, data):
    return spark.createDataFrame(data, FA_SCHEMA)


def test_funnel_edge_rows(spark):
    data = [("s", T0, 1, 5, "5,6,", None),       # click and order in one row, trailing comma
            ("s", T0, 1, -1, None, "7"),         # category only paid
            ("t", T0, 1, 5, None, None)]
    got = rows(category.category_funnel(fa(spark, data)))
    assert got == [(5, 2, 1, 0), (6, 0, 1, 0), (7, 0, 0, 1)]
    assert rows(category.active_categories(fa(spark, data))) == [(5,), (6,), (7,)]
    assert rows(category.order_counts(fa(spark, data))) == [(5, 1), (6, 1)]


def test_top10_ties_and_fewer_than_ten(spark):
    funnel = spark.createDataFrame(
        [(1, 5, 1, 1), (2, 5, 2, 0), (3, 5, 2, 1), (4, 5, 2, 1), (5, 9, 0, 0)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    got = [r["category_id"] for r in category.top_categories(funnel, 10).collect()]
    assert got == [5, 3, 4, 2, 1]


def test_top_sessions_per_category_ties(spark):
    counts = spark.createDataFrame([(1, f"s{i:02d}", 3 if i < 12 else 1) for i in range(15)],
                                   "category_id bigint, session_id string, click_count bigint")
    got = [r["session_id"] for r in category.top_sessions(counts, 10).orderBy("session_id").collect()]
    assert got == [f"s{i:02d}" for i in range(10)]


def _actions(spark, seq):
    return spark.createDataFrame([(s, t, p) for s, t, p in seq],
                                 "session_id string, action_time timestamp_ntz, page_id bigint")


def test_page_pairs_same_second_and_repeats(spark):
    seq = [("s", T0, 2), ("s", T0, 1), ("s", T0 + dt.timedelta(seconds=1), 2),
           ("s", T0 + dt.timedelta(seconds=2), 2), ("u", T0, 1)]
    got = rows(pageflow.page_pairs(_actions(spark, seq)))
    assert got == [("s", 1, 2), ("s", 2, 2), ("s", 2, 2)]


def _brute_pairs(df):
    w = Window.partitionBy("session_id").orderBy("action_time", "page_id")
    return (df.withColumn("next_page_id", F.lead("page_id").over(w))
            .where(F.col("next_page_id").isNotNull()).select("session_id", "page_id", "next_page_id"))


@pytest.mark.parametrize("tasks", [1, 4, 64])
def test_ranged_pairs_equal_one_pass(spark, monkeypatch, tasks):
    monkeypatch.setattr(ordered, "SAMPLED", 2)  # nearly every session counts as hot
    rnd = random.Random(7)
    seq = []
    for s in range(20):
        t = T0
        for _ in range(rnd.randint(1, 40)):
            t += dt.timedelta(seconds=rnd.choice([0, 1, 5, 50, 400, 4000]))
            seq.append((f"s{s}", t, rnd.randint(0, 5)))
    df = _actions(spark, seq)
    want = rows(_brute_pairs(df))
    assert rows(pageflow.consecutive_pairs(df, "session_id", "action_time", "page_id", tasks)) == want


def test_convert_rate_unseen_pair_and_zero_prev(spark):
    seq = [("s", T0, 1), ("s", T0 + dt.timedelta(seconds=1), 2), ("t", T0, 1),
           ("t", T0 + dt.timedelta(seconds=1), 2), ("t", T0 + dt.timedelta(seconds=2), 9)]
    acts = _actions(spark, seq)
    flow = (1, 2, 3, 4)
    counts = pageflow.page_pair_counts(pageflow.page_pairs(acts), flow)
    out = rows(pageflow.convert_rate(spark, counts, pageflow.start_page_count(acts, flow), flow))
    assert out == [(1, "1_2", 2, 2, 1.0), (2, "2_3", 0, 2, 0.0), (3, "3_4", 0, 0, None)]


def test_single_page_flow_has_no_steps(spark):
    acts = _actions(spark, [("s", T0, 1)])
    counts = pageflow.page_pair_counts(pageflow.page_pairs(acts), (1,))
    assert pageflow.convert_rate(spark, counts, pageflow.start_page_count(acts, (1,)), (1,)).count() == 0


def test_render_rates(spark):
    rates = spark.createDataFrame([(2, "2_3", 0.5), (1, "1_2", 0.25)], "step int, page_pair string, rate double")
    assert pageflow.render_rates(rates).first()[0] == "1_2=0.25|2_3=0.5"

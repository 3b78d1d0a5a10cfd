"""Hand-written edge fixtures for the session operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shoplens.operators import sampling, sessions
from shoplens.params import TaskParams
from shoplens.schema import USER_INFO, USER_VISIT_ACTION

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def action(sid, uid, sec, kw=None, cat=-1, page=1, date="2024-01-01", order=None, pay=None):
    t = T0 + dt.timedelta(seconds=sec)
    return (date, uid, sid, page, t, kw, cat, -1 if cat == -1 else 7, order, None, pay, None, 0)


def lengths_df(spark, visit_lengths):
    """One two-action session per visit length (start and end)."""
    data = []
    for i, v in enumerate(visit_lengths):
        data += [action(f"s{i}", 1, 0), action(f"s{i}", 1, v)]
    return spark.createDataFrame(data, USER_VISIT_ACTION)


def test_visit_buckets_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    summary = sessions.session_summary(lengths_df(spark, lengths))
    got = dict((r["visit_length"], r["b"]) for r in
               summary.select("visit_length", sessions.visit_bucket().alias("b")).collect())
    assert got == {0: None, 1: "1s_3s", 3: "1s_3s", 4: "4s_6s", 6: "4s_6s", 7: "7s_9s", 9: "7s_9s",
                   10: "10s_30s", 30: "10s_30s", 31: "30s_60s", 60: "30s_60s", 61: "1m_3m",
                   180: "1m_3m", 181: "3m_10m", 600: "3m_10m", 601: "10m_30m", 1800: "10m_30m",
                   1801: "30m"}
    hist = {(r["kind"], r["bucket"]): r["cnt"] for r in sessions.length_histogram(summary).collect()}
    assert sum(v for (k, _), v in hist.items() if k == "visit_length") == len(lengths) - 1
    assert hist[("step_length", "1_3")] == len(lengths)


def test_step_buckets_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    data = [action(f"s{n}", 1, i) for n in steps for i in range(n)]
    summary = sessions.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION))
    got = dict((r["step_length"], r["b"]) for r in
               summary.select("step_length", sessions.step_bucket().alias("b")).collect())
    assert got == {1: "1_3", 3: "1_3", 4: "4_6", 6: "4_6", 7: "7_9", 9: "7_9", 10: "10_30",
                   30: "10_30", 31: "30_60", 60: "30_60", 61: "60"}


@pytest.mark.parametrize("n,d,want", [(1, 200, 0.01), (57, 200, 0.29), (201, 200, 1.01),
                                      (1, 8, 0.13), (1, 3, 0.33), (2, 3, 0.67), (0, 5, 0.0)])
def test_half_up_ratio(spark, n, d, want):
    from shoplens.functions.scalar import half_up_ratio
    got = spark.range(1).select(half_up_ratio(F.lit(n), F.lit(d)).alias("r")).first()["r"]
    assert got == want


def test_ratio_no_sessions(spark):
    empty = spark.createDataFrame([], USER_VISIT_ACTION)
    r = sessions.stat_ratio(sessions.session_summary(empty)).first()
    assert r["session_count"] == 0
    assert all(r[c] == 0.0 for c in sessions.ratio_columns())


def test_ratio_values(spark):
    # 4 sessions: lengths 1 (1s_3s), 2 (1s_3s), 5 (4s_6s), 0 (no bucket)
    summary = sessions.session_summary(lengths_df(spark, [1, 2, 5, 0]))
    r = sessions.stat_ratio(summary).first()
    assert r["session_count"] == 4
    assert r["visit_length_1s_3s_ratio"] == 0.5
    assert r["visit_length_4s_6s_ratio"] == 0.25
    assert r["step_length_1_3_ratio"] == 1.0


def test_keyword_and_category_lists(spark):
    data = [action("s", 1, 0, kw="kw1"), action("s", 1, 1, kw="kw10"), action("s", 1, 2, kw="kw11"),
            action("s", 1, 3, kw="kw1"), action("s", 1, 4, cat=50), action("s", 1, 5, cat=44),
            action("s", 1, 6, cat=5), action("s", 1, 7, cat=50), action("t", 2, 0)]
    out = {r["session_id"]: r for r in
           sessions.public(sessions.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION))).collect()}
    assert out["s"]["search_keywords"] == "kw1,kw10,kw11"
    assert out["s"]["click_category_ids"] == "5,44,50"
    assert out["s"]["step_length"] == 8 and out["s"]["visit_length"] == 7
    assert out["t"]["search_keywords"] is None and out["t"]["click_category_ids"] is None


def _users(spark):
    return spark.createDataFrame([
        (1, "u1", "n1", 30, "professional1", "city1", "male"),
        (2, "u2", "n2", 50, "professional2", "city2", "female"),
        (3, "u3", "n3", 51, "professional3", "city3", "male"),
    ], USER_INFO)


def _enriched(spark, params):
    data = [action("a", 1, 0, kw="kw1", cat=3), action("b", 2, 0), action("c", 3, 0, kw="kw2"),
            action("d", 9, 0)]  # user 9 is unknown: dropped by the inner join
    summary = sessions.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION), params)
    return sessions.enrich(summary, _users(spark))


@pytest.mark.parametrize("params,want", [
    (TaskParams(), {"a", "b", "c"}),                                  # blank: no constraint
    (TaskParams(start_age=40), {"a", "b", "c"}),                      # one bound only: passes
    (TaskParams(start_age=30, end_age=50), {"a", "b"}),               # both bounds inclusive
    (TaskParams(sex="male"), {"a", "c"}),
    (TaskParams(professionals=("professional2",)), {"b"}),
    (TaskParams(cities=("city1", "city3")), {"a", "c"}),
    (TaskParams(keywords=("kw2", "kw9")), {"c"}),                     # no keyword: fails
    (TaskParams(category_ids=(3,)), {"a"}),
    (TaskParams(start_age=20, end_age=59, sex="male", keywords=("kw1",)), {"a"}),
])
def test_filters(spark, params, want):
    got = {r["session_id"] for r in sessions.filter_sessions(_enriched(spark, params), params).collect()}
    assert got == want


def test_params_from_json():
    p = TaskParams.from_json('{"startDate": "2020-03-01", "endDate": "2020-03-30", "startAge": 20, '
                             '"endAge": 50, "professionals": "", "cities": "", "sex": "", '
                             '"keywords": "", "categoryIds": "1, 2", "targetPageFlow": "1,2,3"}')
    assert (p.start_date, p.end_date, p.start_age, p.end_age) == ("2020-03-01", "2020-03-30", 20, 50)
    assert p.professionals == () and p.sex is None and p.category_ids == (1, 2)
    assert p.target_page_flow == (1, 2, 3)


def test_missing_params_set_no_bound(spark):
    from shoplens.sources.actions import scan_actions
    actions = spark.createDataFrame([("1999-12-31",), ("2024-01-05",), ("2031-01-01",)], "date string")
    for text, want in (("{}", 3), ('{"startDate": "2020-05-01", "endDate": ""}', 2), ('{"endDate": "2024-01-05"}', 2)):
        p = TaskParams.from_json(text)
        assert p.target_page_flow == () and scan_actions(actions, p).count() == want


def _sessions_at(spark, starts):
    """One single-action session per start time."""
    data = [(d.strftime("%Y-%m-%d"), 1, f"s{i}", 1, d, None, -1, -1, None, None, None, None, 0)
            for i, d in enumerate(starts)]
    return spark.createDataFrame(data, USER_VISIT_ACTION)


def test_sampling_two_dates_and_single_session_hour(spark):
    starts = ([dt.datetime(2024, 1, 1, 9, m) for m in range(6)] + [dt.datetime(2024, 1, 1, 10, 0)]
              + [dt.datetime(2024, 1, 2, 9, m) for m in range(3)])
    summary = sessions.session_summary(_sessions_at(spark, starts))
    quota = sampling.extract_quota(sampling.hour_counts(summary), total=10)
    got = {(r["date"], r["hour"]): (r["cnt"], r["day_cnt"], r["quota"]) for r in quota.collect()}
    # day quota = 10 // 2 = 5; hour 09 of day 1: least(6, 6*5 // 7 = 4); hour 10: 1*5 // 7 = 0
    assert got == {("2024-01-01", "09"): (6, 7, 4), ("2024-01-01", "10"): (1, 7, 0),
                   ("2024-01-02", "09"): (3, 3, 3)}
    picked = sampling.extract_sessions(summary, quota, total=10)
    assert picked.count() == 7
    again = sampling.extract_sessions(summary, quota, total=10)
    assert rows(picked.select("session_id")) == rows(again.select("session_id"))  # reproducible


def test_sampling_total_smaller_than_days_and_empty(spark):
    starts = [dt.datetime(2024, 1, d, 9, 0) for d in (1, 2, 3)]
    summary = sessions.session_summary(_sessions_at(spark, starts))
    quota = sampling.extract_quota(sampling.hour_counts(summary), total=2)
    assert {r["quota"] for r in quota.collect()} == {0}
    assert sampling.extract_sessions(summary, quota, total=2).count() == 0
    empty = sessions.session_summary(spark.createDataFrame([], USER_VISIT_ACTION))
    assert sampling.extract_quota(sampling.hour_counts(empty)).count() == 0


def test_overlap_flags_need_no_lists(spark):
    """A session with very many keywords is filtered by a flag: no list is built."""
    many = spark.range(300_000).selectExpr(
        "'2024-01-01' AS date", "1L AS user_id", "if(id % 3 = 0, 'small', 'huge') AS session_id", "id AS page_id",
        "timestamp_ntz'2024-01-01 00:00:00' AS action_time", "if(id % 3 = 0, 'kw0', concat('kw', id)) AS search_keyword",
        "id AS click_category_id")
    p = TaskParams(keywords=("kw299999", "kw7"))
    kept = sessions.filter_sessions(sessions.enrich(sessions.session_summary(many, p), _users(spark)), p).select("session_id")
    assert [r[0] for r in kept.collect()] == ["huge"]
    assert "collect_set" not in kept._jdf.queryExecution().executedPlan().toString()


def test_filter_without_its_flags_is_refused(spark):
    from pyspark.errors import AnalysisException
    summary = sessions.session_summary(spark.createDataFrame([action("a", 1, 0)], USER_VISIT_ACTION))
    with pytest.raises(AnalysisException):
        sessions.filter_sessions(summary, TaskParams(keywords=("kw1",)))


@pytest.mark.parametrize("total", [3, 2000, 200_000])
def test_sample_equals_the_ranking(spark, monkeypatch, total):
    """The cells give the sample of a ranking of whole hours, and no window holds an hour."""
    from pyspark.sql import Window, functions as F
    monkeypatch.setattr(sampling, "CELL", 20)
    s = spark.range(4000).selectExpr("concat('s', id) AS session_id", "if(id % 3 = 0, NULL, 'k') AS search_keywords", "NULL AS click_category_ids",
                                     "timestampadd(MINUTE, cast(if(id % 2 = 0, 5, id * 7) AS INT), timestamp_ntz'2024-01-01 00:00:00') AS start_time")
    quota = sampling.extract_quota(sampling.hour_counts(s), total)
    w = Window.partitionBy("date", "hour").orderBy(sampling.sample_hash(), "session_id")
    ranked = sampling.with_date_hour(s).join(quota, ["date", "hour"]).withColumn("rn", F.row_number().over(w)).where("rn <= quota")
    assert rows(sampling.extract_sessions(s, quota, total).select("session_id")) == rows(ranked.select("session_id"))
    cells = sampling.in_cells(s, quota).groupBy("date", "hour", "_cell").count()
    assert (cells.agg(F.max("count")).first()[0] or 0) < 60


def test_one_session_rule(spark):
    """A session with two users qualifies by its own user on either path."""
    from shoplens.operators import category
    data = [action("two", 1, 0, cat=1), action("two", 2, 1, cat=2), action("one", 2, 0, cat=3)]
    acts, users = spark.createDataFrame(data, USER_VISIT_ACTION), _users(spark)
    assert not sessions.one_user_each(acts) and sessions.one_user_each(acts.where("session_id = 'one'"))
    assert not sessions.one_user_each(spark.createDataFrame([action("a", 1, 0), action("a", None, 1)], USER_VISIT_ACTION))
    for p in (TaskParams(sex="male"), TaskParams(professionals=("professional2",))):
        by_flag = TaskParams(**{**p.__dict__, "category_ids": (1, 2, 3)})  # met by every session: takes the session path
        assert rows(category.actions_of_qualifying_sessions(acts, users, p)) == \
            rows(category.actions_of_qualifying_sessions(acts, users, by_flag))


TASK = """{startDate:"2020-03-01", \\
  endDate:"2020-03-30", \\
  startAge: 20, \\
  endAge: 50, \\
  professionals: "",  \\
  cities: "", \\
  sex:"", \\
  keywords:"a, \\"b\\" }", \\
  categoryIds:"", \\
  targetPageFlow:"1,2,3,4,5,6,7"}"""


def test_unquoted_task_object():
    p = TaskParams.from_json(TASK)
    assert (p.start_date, p.end_date, p.start_age, p.end_age) == ("2020-03-01", "2020-03-30", 20, 50)
    assert p.keywords == ("a", '"b" }') and p.target_page_flow == tuple(range(1, 8)) and p.sex is None
    assert TaskParams.from_json("{ 'sex' : male, startAge:07, cities: [city1, 'city 2',], flag: null, }").cities == ("city1", "city 2")
    assert TaskParams.from_json("{}") == TaskParams()


@pytest.mark.parametrize("text,place", [('{startAge: 20', "line 1, column 14"), ('{startAge 20}', "line 1, column 11"), ('{\n sex: "male}', "line 2, column 7"),
                                        ('{a: 1} x', "line 1, column 8"), ('{a: 1, a: 2}', "line 1, column 8"), ('[1]', "line 1, column 1"), ('{a: ,}', "line 1, column 5")])
def test_broken_task_object_tells_its_place(text, place):
    with pytest.raises(ValueError, match=place):
        TaskParams.from_json(text)

"""Production tables: layout, checked readers, plans; options of the live log; zones; the command line."""

import datetime as dt
import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL, rows
from shoplens.operators import sessions
from shoplens.params import TaskParams
from shoplens.plans import jobs
from shoplens.plans.tables import Tables
from shoplens.schema import USER_INFO, USER_VISIT_ACTION
from shoplens.sinks.jdbc import save_table
from shoplens.sources import adlog, tables
from shoplens.sources.actions import scan_actions, scan_clicks

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def actions_table(spark, tmp_path):
    name = f"actions_{uuid.uuid4().hex[:8]}"
    tables.save_actions(Tables(spark, SF_SMALL).actions, name, 8, str(tmp_path / name))
    yield name
    spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_equals_its_source(spark, actions_table):
    got = tables.read_actions(spark, actions_table)
    assert got.schema == USER_VISIT_ACTION
    assert rows(got) == rows(Tables(spark, SF_SMALL).actions)


def test_date_range_prunes_folders_and_click_reaches_the_files(spark, actions_table):
    text = plan(scan_clicks(tables.read_actions(spark, actions_table), TaskParams(start_date="2024-01-05", end_date="2024-01-08")))
    folders = text[text.index("PartitionFilters: ["):].split("PushedFilters")[0]
    assert "2024-01-05" in folders and "2024-01-08" in folders
    pushed = text[text.index("PushedFilters: ["):].split("ReadSchema")[0]
    assert "Not(EqualTo(click_product_id,-1))" in pushed
    assert "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in text


def test_sessions_of_a_bucketed_table_are_not_shuffled(spark, actions_table):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = sessions.public(sessions.session_summary(scan_actions(tables.read_actions(spark, actions_table), TaskParams(start_date="2024-01-02"))))
        assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_file_per_date_and_bucket(spark, actions_table):
    files = [r[0] for r in spark.table(actions_table).select(F.input_file_name()).distinct().collect()]
    places = [(f.split("date=")[1][:10], f.rsplit("_", 1)[1]) for f in files]
    assert len(set(places)) == len(places)


def test_replace_table(spark, tmp_path):
    name, users = f"u_{uuid.uuid4().hex[:8]}", Tables(spark, SF_SMALL).users
    save_table(users, name, path=str(tmp_path / name))
    save_table(users.where("user_id < 10"), name, path=str(tmp_path / name))
    assert rows(tables.read_users(spark, name)) == rows(users.where("user_id < 10"))
    spark.sql(f"DROP TABLE {name}")


def test_text_times_narrow_numbers_and_typed_dates(spark):
    data = [("2024-01-01", 1, "s", 1, "2024-01-01 5:03:09", None, -1, -1, None, None, None, None, 2)]
    text = spark.createDataFrame(data, "date string, user_id int, session_id string, page_id int, action_time string, search_keyword string, "
                                 "click_category_id int, click_product_id long, order_category_ids string, order_product_ids string, "
                                 "pay_category_ids string, pay_product_ids string, city_id short, other string".replace(", other string", ""))
    got = tables.typed(text.withColumn("date", F.col("date").cast("date")).withColumn("more", F.lit(1)), USER_VISIT_ACTION)
    assert got.schema.simpleString() == USER_VISIT_ACTION.simpleString()
    r = got.first()
    assert (r.date, r.user_id, r.action_time) == ("2024-01-01", 1, dt.datetime(2024, 1, 1, 5, 3, 9))


def test_wrong_tables_are_refused(spark):
    users = Tables(spark, SF_SMALL).users
    with pytest.raises(ValueError, match="age"):
        tables.typed(users.drop("age"), USER_INFO)
    with pytest.raises(TypeError, match="age"):
        tables.typed(users.withColumn("age", F.col("age").cast("string")), USER_INFO)


def test_jobs_from_tables(spark, actions_table, tmp_path):
    t = Tables(spark, SF_SMALL)
    taken = {}
    jobs.run_area_job(jobs.ShopTables(tables.read_actions(spark, actions_table), t.users, t.products, t.cities), TaskParams(),
                      lambda df, name: taken.update({name: rows(df)}), "x")
    assert taken == {"area_top3_product": rows(entry.queries()["area_top3"](spark, SF_SMALL))}


def test_jdbc_writer_gets_every_result(spark, monkeypatch):
    """What would be appended; no database is started."""
    seen = []
    monkeypatch.setattr(jobs, "append_jdbc", lambda df, url, table, properties: seen.append((url, table, properties, df.columns[0], df.count())))
    t = Tables(spark, SF_SMALL)
    jobs.run_page_job(jobs.ShopTables(t.actions), TaskParams(target_page_flow=(1, 2, 3)), jobs.to_jdbc("jdbc:x:y", "t9", {"user": "u"}), "t9")
    assert seen == [("jdbc:x:y", "page_split_convert_rate", {"user": "u"}, "task_id", 2), ("jdbc:x:y", "page_split_convert_rate_text", {"user": "u"}, "task_id", 1)]


def test_kafka_options():
    assert adlog.kafka_options("a:1,b:2", "log") == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "log", "startingOffsets": "latest", "failOnDataLoss": "true"}
    got = adlog.kafka_options("a:1", "x, y", {"x": {0: 5, 1: -2}}, 1000, "g")
    assert got["startingOffsets"] == '{"x": {"0": 5, "1": -2}}' and got["maxOffsetsPerTrigger"] == "1000" and got["groupIdPrefix"] == "g"
    for bad in (("", "t"), ("a:1", " "), ("a:1", "t", "soon"), ("a:1", "t", {"u": {0: 1}})):
        with pytest.raises(ValueError):
            adlog.kafka_options(*bad)


def test_zone_of_days_and_hours(spark):
    line = spark.createDataFrame([("1704064200000 p c 1 2",)], "value string")  # 2023-12-31 23:10 UTC
    assert adlog.parse_ad_log(line).first().date == "20231231"
    there = adlog.parse_ad_log(line, "Asia/Shanghai").first()
    assert (there.date, there.ts) == ("20240101", dt.datetime(2024, 1, 1, 7, 10))


def test_ads_command(tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.txt").write_text("".join(f"{1704064200000 + i} p c 1 2\n" for i in range(12)) + "broken\n")
    r = subprocess.run([sys.executable, "-m", "shoplens", "--master", "local[2]", "ads", "--root", str(tmp_path / "root"), "--feed", str(tmp_path / "feed"),
                        "--zone", "Asia/Shanghai", "--once"], capture_output=True, text=True, cwd=REPO, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert (tmp_path / "root" / "tables" / "ad_stat" / "_log").exists() and (tmp_path / "root" / "tables" / "ad_blacklist" / "_log").exists()

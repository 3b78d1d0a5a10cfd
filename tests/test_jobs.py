"""The applications write every result once, tagged with the task id, equal to the per-key plans."""

import os
import subprocess
import sys
import tempfile

from conftest import SF_SMALL, rows
import __spark_entry__ as entry
from shoplens.params import DEFAULT_SESSION_PARAMS, QUERY_PARAMS
from shoplens.plans import jobs
from shoplens.plans.catalog import SAMPLE_TOTAL
from shoplens.plans.tables import Tables


def _tables(spark):
    t = Tables(spark, SF_SMALL)
    return jobs.ShopTables(t.actions, t.users, t.products, t.cities)


def test_session_job_matches_keys(spark):
    out = tempfile.mkdtemp(prefix="shoplens-job-")
    jobs.run_session_job(_tables(spark), DEFAULT_SESSION_PARAMS, out, "t1", SAMPLE_TOTAL)
    jobs.run_session_job(_tables(spark), DEFAULT_SESSION_PARAMS, out, "t1", SAMPLE_TOTAL)  # rerun replaces
    q = entry.queries()
    pairs = {"session_stat_ratio": "session_stat_ratio", "session_extract": "session_extract",
             "top10_category": "top10_category", "top10_session": "top_sessions_per_category",
             "session_detail": "session_extract_detail"}
    for table, key in pairs.items():
        got = spark.read.parquet(f"{out}/{table}")
        assert set(got.select("task_id").distinct().toPandas()["task_id"]) == {"t1"}
        want = q[key](spark, SF_SMALL)
        assert rows(got.select(*want.columns)) == rows(want), table


def test_page_and_area_jobs(spark):
    out = tempfile.mkdtemp(prefix="shoplens-job-")
    jobs.run_page_job(_tables(spark), QUERY_PARAMS, out, "p")
    jobs.run_area_job(_tables(spark), QUERY_PARAMS, out, "a")
    q = entry.queries()
    want = q["page_convert_rate"](spark, SF_SMALL)
    assert rows(spark.read.parquet(f"{out}/page_split_convert_rate").select(*want.columns)) == rows(want)
    text = spark.read.parquet(f"{out}/page_split_convert_rate_text").first()["convert_rate"]
    assert text.startswith("1_2=") and text.count("|") == 5
    want = q["area_top3"](spark, SF_SMALL)
    assert rows(spark.read.parquet(f"{out}/area_top3_product").select(*want.columns)) == rows(want)


def test_cli_runs(tmp_path):
    r = subprocess.run([sys.executable, "-m", "shoplens", "area", "--sf-dir", SF_SMALL, "--out",
                        str(tmp_path), "--master", "local[2]"], capture_output=True, text=True,
                       cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                       timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert (tmp_path / "area_top3_product").exists()

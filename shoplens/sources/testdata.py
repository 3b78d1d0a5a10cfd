"""Readers for the driver's parquet tables and the adapter views over them.

The driver ships TPC-H-like tables plus an ``events`` table; the analytics need the shop's
``user_visit_action``, ``user_info``, ``product_info`` and an advertisement click log. The
adapters derive those deterministically with column expressions only, so they stay lazy and let
Catalyst prune columns and push filters into the parquet scan of ``events`` / ``customer`` /
``part``. The same derivations are written in DuckDB SQL in ``shoplens.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def action_base(events: DataFrame) -> DataFrame:
    """Session start day ``d0`` and second offset ``sec`` per event.

    user_id % 3 = 0 gives one session per day, 1 per week, 2 per month, so every visit-length
    bucket is populated. (Adapters are written as SQL expression strings: one call to the JVM per
    projection instead of one per column expression.)
    """
    return events.selectExpr(
        "event_id", "user_id", "event_type",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k",
        """CASE user_id % 3 WHEN 0 THEN day(ts)
                WHEN 1 THEN CAST(floor((day(ts) - 1) / 7) AS INT) * 7 + 1 ELSE 1 END AS d0""",
        """(user_id % 22) * 3600
             + CAST(floor(value * CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 10 END) AS BIGINT)
             AS sec""")


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = action_base(read_table(spark, sf_dir, "events"))
    return b.selectExpr(
        "CAST(make_date(2024, 1, d0) AS STRING) AS date",
        "user_id",
        "concat('u', CAST(user_id AS STRING), '-d', CAST(d0 AS STRING)) AS session_id",
        "event_id % 10 AS page_id",
        "timestampadd(SECOND, sec, CAST(make_date(2024, 1, d0) AS TIMESTAMP_NTZ)) AS action_time",
        "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 12 AS STRING)) END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN (event_id * 13) % 120 ELSE -1 END AS click_product_id",
        """CASE WHEN event_type = 'signup'
                THEN concat(CAST(k AS STRING), ',', CAST((k * 7 + 1) % 100 AS STRING)) END
             AS order_category_ids""",
        "CASE WHEN event_type = 'signup' THEN CAST(event_id % 120 AS STRING) END AS order_product_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END AS pay_category_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 120 AS STRING) END AS pay_product_ids",
        "event_id % 10 AS city_id",
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.selectExpr(
        "c_custkey AS user_id",
        "concat('user', CAST(c_custkey AS STRING)) AS username",
        "c_name AS name",
        "CAST((c_custkey * 7) % 60 AS INT) AS age",
        "concat('professional', CAST(c_custkey % 100 AS STRING)) AS professional",
        "concat('city', CAST(c_nationkey AS STRING)) AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """concat('{"product_status": ', CAST(p_size % 2 AS STRING), '}') AS extend_info""",
    )


# epoch milliseconds of a TIMESTAMP_NTZ, floored
EPOCH_MILLIS_SQL = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})"


def ad_log(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """One text column ``value``: ``<epoch ms> <province> <city> <userid> <adid>``.

    A quarter of the lines is concentrated on users 0-2 and ad 0 (a hot key by design).
    ``keep_event_id`` also returns the source ``event_id`` (to split the log into batches).
    """
    e = read_table(spark, sf_dir, "events").where("event_type IN ('click', 'view')")
    line = f"""concat_ws(' ', CAST({EPOCH_MILLIS_SQL.format(ts="ts")} AS STRING),
                  CAST(user_id % 5 AS STRING), CAST(user_id % 10 AS STRING),
                  CAST(CASE WHEN event_id % 4 = 0 THEN user_id % 3 ELSE user_id END AS STRING),
                  CAST(CASE WHEN event_id % 4 = 0 THEN 0
                            ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 20 END AS STRING))
               AS value"""
    return e.selectExpr("event_id", line) if keep_event_id else e.selectExpr(line)

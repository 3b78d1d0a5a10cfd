"""Explicit table schemas (no inference) for inputs and result tables."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, I, D = T.LongType(), T.StringType(), T.IntegerType(), T.DoubleType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USER_VISIT_ACTION = struct(
    ("date", S), ("user_id", L), ("session_id", S), ("page_id", L),
    ("action_time", T.TimestampNTZType()), ("search_keyword", S),
    ("click_category_id", L), ("click_product_id", L),
    ("order_category_ids", S), ("order_product_ids", S),
    ("pay_category_ids", S), ("pay_product_ids", S), ("city_id", L),
)

USER_INFO = struct(("user_id", L), ("username", S), ("name", S), ("age", I),
                   ("professional", S), ("city", S), ("sex", S))

PRODUCT_INFO = struct(("product_id", L), ("product_name", S), ("extend_info", S))

CITY_AREA = struct(("city_id", L), ("city_name", S), ("area", S))

AD_LOG_RAW = struct(("value", S))

AD_CLICK = struct(("ts", T.TimestampNTZType()), ("date", S), ("province", S), ("city", S),
                  ("userid", L), ("adid", L))

# Result tables of the keyed sinks.
AD_STAT = struct(("date", S), ("province", S), ("city", S), ("adid", L), ("click_count", L))
AD_USER_CLICK_COUNT = struct(("date", S), ("userid", L), ("adid", L), ("click_count", L))
AD_PROVINCE_TOP3 = struct(("date", S), ("province", S), ("adid", L), ("click_count", L))
AD_CLICK_TREND = struct(("date", S), ("hour", S), ("minute", S), ("adid", L), ("click_count", L))
AD_BLACKLIST = struct(("userid", L))
